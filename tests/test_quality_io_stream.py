import pytest
from pyspark.sql import functions as F

from arrears.operators import quality as qa
from arrears.session import scratch_path
from arrears.sources import io as sio
from arrears.sources.adapters import book_from_testdata
from arrears.streaming import rates_refresh as rr
from tests import fixtures as fx
from tests.conftest import SMALL
from tests.fixtures import d


def test_orphan_and_duplicates(spark):
    lo = fx.loans(spark, [(1, 1, 100, 12, d("2024-01-01"), "active")])
    pay = fx.payments(spark, [(1, 1, d("2024-01-01"), 1, 0), (1, 99, d("2024-01-01"), 1, 0),
                              (2, 99, d("2024-02-01"), 1, 0)])
    cust = fx.customers(spark, [(1, 1000, "Retired", 700)])
    acts = fx.actions(spark, [])
    tables = {"customers": cust, "loans": lo, "payment_history": pay, "collection_actions": acts}
    fk = {r.child_table: (r.orphan_rows, r.orphan_keys) for r in qa.fk_violations(tables).collect()}
    assert fk == {"loans": (0, 0), "payment_history": (2, 1), "collection_actions": (0, 0)}
    pk = {r.table_name: r.n_duplicate_keys for r in qa.pk_violations(tables).collect()}
    assert pk["payment_history"] == 1 and pk["loans"] == 0


def test_nulls_and_defaults(spark):
    lo = spark.createDataFrame([(1, 1, None, None, None, None, None)],
                               "loan_id long, customer_id long, principal decimal(12,2), "
                               "interest_rate decimal(5,4), term_months int, origination_date date, "
                               "status string")
    n = {r.column_name: r.null_count for r in qa.null_violations({"loans": lo}).collect()}
    assert n["status"] == 1 and n["loan_id"] == 0
    fixed = qa.apply_defaults("loans", lo).first()
    assert fixed.status == "active"
    rep = qa.defaults_applied({"loans": lo}).first()
    assert (rep.column_name, rep.n_defaulted) == ("status", 1)


def test_dense_ids(spark):
    df = spark.range(0, 1000, numPartitions=7).select(F.col("id").alias("x"))
    ids = sorted(r.surrogate_id for r in qa.dense_ids(df).collect())
    assert ids == list(range(1, 1001))


def test_full_refresh_idempotent(spark):
    book = book_from_testdata(spark, SMALL)
    target = scratch_path(spark, "t-book")
    sio.full_refresh(spark, book, target)
    first = sio.read_published(spark, target)
    a = sorted(sio.table_counts(first).collect())
    rows_once = sorted(first.loans.collect())
    sio.full_refresh(spark, book, target)
    second = sio.read_published(spark, target)
    assert sorted(sio.table_counts(second).collect()) == a == sorted(sio.table_counts(book).collect())
    assert sorted(second.loans.collect()) == rows_once
    assert first.loans.exceptAll(second.loans).count() == 0  # the old version stays readable
    assert sio.published_versions(spark, target).count() == 2


def test_refresh_rejects_orphans(spark):
    book = book_from_testdata(spark, SMALL)
    target = scratch_path(spark, "t-bad")
    sio.full_refresh(spark, book, target)
    good = sorted(sio.table_counts(sio.read_published(spark, target)).collect())
    bad = book.payments.unionByName(fx.payments(spark, [(-1, -42, d("2024-01-01"), 1, 0)]))
    book.payments = bad
    try:
        sio.full_refresh(spark, book, target)
        raise AssertionError("expected a refresh error")
    except sio.RefreshError as e:
        assert "payment_history:loan_id:fk" in str(e)
    # the failed version is not published: readers still see the previous one
    assert sorted(sio.table_counts(sio.read_published(spark, target)).collect()) == good


def test_csv_round_trip(spark):
    lo = book_from_testdata(spark, SMALL).loans
    path = scratch_path(spark, "t-csv")
    sio.write_table(lo, path, "loans", fmt="csv")
    back = sio.read_table(spark, path, "loans", fmt="csv")
    assert back.schema == lo.schema or back.dtypes == lo.dtypes
    assert back.exceptAll(lo).count() == 0 and lo.exceptAll(back).count() == 0


def test_stream_refresh_is_incremental(spark):
    landing = scratch_path(spark, "t-land")
    table = scratch_path(spark, "t-rates")
    ckpt = scratch_path(spark, "t-ckpt")
    first = fx.actions(spark, [(1, 1, d("2024-01-01"), "phone_call", "paid_in_full"),
                               (2, 1, d("2024-01-02"), "phone_call", "no_response")])
    first.write.mode("append").parquet(landing)
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    r1 = {r.action_type: (r.total_actions, r.success_rate) for r in rr.read_rates(spark, table).collect()}
    assert r1 == {"phone_call": (2, 0.5)}
    second = fx.actions(spark, [(3, 1, d("2024-01-03"), "phone_call", "partial_payment"),
                                (4, 1, d("2024-01-04"), "legal_notice", "no_response")])
    second.write.mode("append").parquet(landing)
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    r2 = {r.action_type: (r.total_actions, r.success_rate) for r in rr.read_rates(spark, table).collect()}
    assert r2 == {"phone_call": (3, 0.667), "legal_notice": (1, 0.0)}


def test_stream_refresh_in_bounded_batches(spark):
    landing = scratch_path(spark, "t-land2")
    for k in range(3):  # three files land
        fx.actions(spark, [(10 * k + 1, 1, d("2024-01-01"), "payment_plan", "paid_in_full"),
                           (10 * k + 2, 1, d("2024-01-02"), "payment_plan", "no_response")]
                   ).coalesce(1).write.mode("append").parquet(landing)
    table = scratch_path(spark, "t-rates2")
    q = rr.start_refresh(spark, landing, table, scratch_path(spark, "t-ckpt2"), max_files_per_trigger=1)
    q.awaitTermination()
    got = {r.action_type: (r.total_actions, r.success_rate) for r in rr.read_rates(spark, table).collect()}
    assert got == {"payment_plan": (6, 0.5)}
    assert len(q.recentProgress) >= 3  # one batch per file


def test_csv_read_fails_fast_on_bad_rows(spark):
    import pytest
    path = scratch_path(spark, "t-badcsv")
    spark.createDataFrame([("loan_id,customer_id,principal,interest_rate,term_months,origination_date,status",),
                           ("1,1,not-a-number,0.1,12,2024-01-01,active",)], "value string") \
        .coalesce(1).write.text(path)
    with pytest.raises(Exception):
        sio.read_table(spark, path, "loans", fmt="csv").collect()


def test_refresh_fills_defaults_and_reports_every_problem(spark):
    book = book_from_testdata(spark, SMALL)
    target = scratch_path(spark, "t-defaults")
    book.loans = book.loans.withColumn("status", F.when(F.col("loan_id") % 3 == 0, None).otherwise(F.col("status")))
    full = sio.full_refresh(spark, book, target)
    assert full.loans.where("status is null").count() == 0
    assert full.loans.where("loan_id % 3 = 0 and status <> 'active'").count() == 0
    void = [F.lit(None).cast(f.dataType).alias(f.name) for f in book.payments.schema.fields]
    book.payments = book.payments.unionByName(book.payments.limit(1).select(*void))
    try:
        sio.full_refresh(spark, book, target)
        raise AssertionError("expected a refresh error")
    except sio.RefreshError as e:
        for c in ("payment_id", "loan_id", "due_date", "amount_due"):
            assert f"payment_history:{c}:null" in str(e)


def test_stream_keeps_every_action_type_and_old_versions(spark):
    landing, table, ckpt = (scratch_path(spark, f"t-types-{k}") for k in ("land", "rates", "ckpt"))
    fx.actions(spark, [(1, 1, d("2024-01-01"), "house_visit", "paid_in_full")]).write.parquet(landing)
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    first = rr.read_rates(spark, table)
    assert [r.action_type for r in first.collect()] == ["house_visit"]
    fx.actions(spark, [(2, 1, d("2024-01-01"), "phone_call", "no_response")]).write.mode("append").parquet(landing)
    rr.start_refresh(spark, landing, table, ckpt).awaitTermination()
    assert {r.action_type for r in rr.read_rates(spark, table).collect()} == {"house_visit", "phone_call"}
    assert [r.action_type for r in first.collect()] == ["house_visit"]     # a reader of the old version is undisturbed


def test_scratch_needs_a_shared_folder_on_a_cluster():
    import pytest

    from arrears.session import ensure_checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_registry_describes_the_tables(spark):
    """Names, order, types and keys as registered are what reading and mapping give."""
    from arrears.sources.schemas import FOREIGN_KEYS, TABLES
    book = book_from_testdata(spark, SMALL)
    target = scratch_path(spark, "t-registry")
    sio.write_book(book, target)
    back = sio.read_book(spark, target)
    for name, spec in TABLES.items():
        declared = [(f.name, f.dataType.simpleString()) for f in spec.schema.fields]
        assert [c for c, _ in declared] == spec.columns
        assert book.table(name).dtypes == declared == back.table(name).dtypes
        assert spec.primary_key in spec.columns and set(spec.defaults) <= set(spec.columns)
    for child, column, parent, key in FOREIGN_KEYS:
        assert column in TABLES[child].columns and TABLES[parent].primary_key == key


def test_discard_deletes_the_scratch_table_only(spark):
    from arrears.session import discard, materialise
    a, b = (materialise(spark.range(n).toDF("x"), "t-discard") for n in (3, 5))
    made = materialise(a.join(b, "x"), "t-discard")
    discard(a)
    assert made.count() == 3 and b.count() == 5
    with pytest.raises(Exception):
        spark.read.parquet(a._arrears_scratch).count()


def test_the_load_counts_what_it_writes(spark):
    """Observed counts are those of the written copy, NULLs too."""
    import json
    book = book_from_testdata(spark, SMALL)
    gaps = F.when(F.col("loan_id") % 4 == 0, None).otherwise(F.col("interest_rate"))
    book.loans = book.loans.withColumn("interest_rate", gaps)
    target = scratch_path(spark, "t-observed")
    counts = sio.write_book_observed(book, target)
    back = sio.read_book(spark, target)
    assert {t: n["row_count"] for t, n in counts.items()} == {r.table_name: r.row_count for r in sio.table_counts(back).collect()}
    nulls = {(r.table_name, r.column_name): r.null_count for r in qa.null_violations(dict(back.items())).collect()}
    assert {(t, c): n for t, of in counts.items() for c, n in of.items() if c != "row_count"} == nulls
    assert nulls["loans", "interest_rate"] > 0
    book = book_from_testdata(spark, SMALL)
    sio.full_refresh(spark, book, target + "-full")
    note = json.loads(sio.published_versions(spark, target + "-full").first().note)
    assert note == {t: n["row_count"] for t, n in counts.items()}
