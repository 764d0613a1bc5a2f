"""Quality rules at the level of hosts (operator 5). DataFrame functions only.

Each document is measured and tested against the base rules. Failures are then
summed by host (here: the source), every host's failure rate is shrunk towards
the rate of all hosts with a beta prior fitted to the hosts (method of moments),
and a host whose shrunk rate is above `max_rate` is rejected with all its
documents. The verdict is joined back to the documents.

The measures need no shuffle: repeated windows are found inside the row, from a
sorted array of window hashes. The sums by host are aggregated before the
shuffle, so a hot host costs no more than any other, and the verdicts (one row
per host) are written once so that Spark knows their size when it picks the join.

Defined results
- NULL, empty or blank text: no words, all measures 0, base_failed true.
- NULL host: a host of its own.
- Repeated rows: each row counts and is judged on its own.
- Fewer than two hosts, or hosts that all have the same rate: the prior has the
  strength `default_strength` (in documents) around the mean rate.
- Empty table: no rows.
- Other columns pass through `apply_rules`, whatever their names.

Windows are compared by a 64-bit hash of their three words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrears.llm.common import BLANKS, fresh, let, materialise, words

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3

MAX_RATE = 0.5             # a host is rejected above this shrunk failure rate
DEFAULT_STRENGTH = 20.0    # prior strength where the hosts cannot tell it


def _repeat_words(ws: Column) -> Column:
    """Words inside windows found twice or more, from the array of words."""
    n = F.size(ws)
    starts = F.sequence(F.lit(0), n - WINDOW)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(WINDOW)]))

    def covered(places: Column) -> Column:
        # Each place covers WINDOW words, less what the next one covers too.
        return let(places, lambda p: F.aggregate(
            F.transform(p, lambda at, i: F.least(F.lit(WINDOW), F.coalesce(F.get(p, i + 1) - at, F.lit(WINDOW)))),
            F.lit(0), lambda total, x: total + x))

    def places(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return let(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, i: (F.get(s, i + 1)["h"] == x["h"]) | (
                (i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))),
            lambda x: x["at"])))

    some = let(hashes, lambda hs: F.when(F.size(F.array_distinct(hs)) == F.size(hs), F.lit(0))
               .otherwise(covered(places(hs))))
    return F.when(n < WINDOW, F.lit(0)).otherwise(some)


def measures(text: Column) -> Column:
    """Struct of n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long)."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    counts = let(words(text), lambda ws: F.struct(
        F.size(ws).cast("long").alias("n_words"), F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
        _repeat_words(ws).cast("long").alias("n_repeat_words")))
    dup = let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
    return let(counts, lambda c: F.struct(
        c["n_words"].alias("n_words"),
        c["word_chars"].alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        dup.cast("long").alias("n_dup_lines"),
        c["n_repeat_words"].alias("n_repeat_words")))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (m["n_repeat_words"] * 100 > m["n_words"] * MAX_REPEAT_PERCENT)


def host_verdicts(failures: DataFrame, max_rate: float = MAX_RATE,
                  default_strength: float = DEFAULT_STRENGTH) -> DataFrame:
    """From (host, failed): one row per host with its shrunk rate and `rejected`.

    The prior Beta(m s, (1 - m) s) has the mean m of the hosts' rates; their
    variance v gives the strength s = m (1 - m) / v - 1, if that is positive.
    """
    hosts = failures.groupBy("host").agg(F.count(F.lit(1)).alias("docs"),
                                         F.sum(F.col("failed").cast("long")).alias("fails"))
    hosts = materialise(hosts, "host-sums")
    rate = F.col("fails") / F.col("docs")
    prior = hosts.agg(F.avg(rate).alias("m"), F.var_pop(rate).alias("v"))
    raw = F.col("m") * (1 - F.col("m")) / F.nullif(F.col("v"), F.lit(0.0)) - 1
    prior = prior.select("m", F.when(raw > 0, raw).otherwise(F.lit(default_strength)).alias("s")).first()
    mean, strength = (prior["m"] or 0.0), prior["s"]
    shrunk = (F.col("fails") + F.lit(mean * strength)) / (F.col("docs") + F.lit(strength))
    return materialise(hosts.select("host", "docs", "fails", shrunk.alias("rate"),
                                    (shrunk > max_rate).alias("rejected")), "host-verdicts")


def apply_rules(docs: DataFrame, *, text_col="text", host_col="source",
                max_rate: float = MAX_RATE) -> tuple[DataFrame, dict[str, str]]:
    """`docs` with a struct of measures, base_failed and kept; and the names of these columns."""
    name = {n: fresh(docs, n) for n in ("measures", "base_failed", "kept")}
    measured = docs.withColumn(name["measures"], measures(docs[text_col]))
    measured = measured.withColumn(name["base_failed"], base_failed(measured[name["measures"]]))
    verdicts = host_verdicts(measured.select(measured[host_col].alias("host"),
                                             measured[name["base_failed"]].alias("failed")), max_rate)
    host, bad = fresh(measured, "rule_host"), fresh(measured, "rule_rejected")
    verdicts = verdicts.select(F.col("host").alias(host), F.col("rejected").alias(bad))
    judged = measured.join(verdicts, measured[host_col].eqNullSafe(verdicts[host]), "left")
    kept = ~F.col(name["base_failed"]) & ~F.coalesce(F.col(bad), F.lit(False))
    return judged.withColumn(name["kept"], kept).drop(host, bad), name


def judge(docs: DataFrame, *, id_col="doc_id", text_col="text", host_col="source",
          max_rate: float = MAX_RATE) -> DataFrame:
    """One row per document: doc_id, the measures, base_failed, kept (no text moves or is read twice)."""
    narrow = docs.select(docs[id_col].alias("doc_id"), docs[host_col].alias("host"),
                         measures(docs[text_col]).alias("m"))
    narrow = materialise(narrow.select("doc_id", "host", "m.*", base_failed(F.col("m")).alias("base_failed")), "host-docs")
    verdicts = host_verdicts(narrow.select("host", F.col("base_failed").alias("failed")), max_rate)
    verdicts = verdicts.select(F.col("host").alias("at"), "rejected")
    return (narrow.join(verdicts, narrow["host"].eqNullSafe(verdicts["at"]), "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", (~F.col("base_failed") & ~F.coalesce("rejected", F.lit(False))).alias("kept")))
