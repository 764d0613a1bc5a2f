"""URL filters with dated lists (operator 8). DataFrame functions only.

A list entry says that from a moment on a domain (with all below it) has a
category, until the next entry of the same domain. Entries become validity
intervals; each capture is joined with the intervals that hold at its fetch
time, for its host and every parent domain; the longest domain wins.

The interval ends come in two steps, so that a domain with very many entries is
not one group: within (domain, day), then over the first entries of each day.
The as-of join is an equi-join on (domain, day), with intervals cut at days, and
a comparison inside the day. It is evaluated once per (host, fetch time), and the
verdicts are joined back to the captures on these two.

Defined results
- NULL or unusable URL: host "", no entry, kept. NULL fetch time: no entry, kept.
- Entries with a NULL domain or time are no entries. Of several entries of one
  domain and time the largest category counts. A capture at the very time of an
  entry is under that entry.
- Repeated captures: each row is judged. Empty tables: no rows, or no entries.
- Extra columns pass through `filter_captures`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from arrears.llm.common import ascii_lower, fresh, materialise, table

HOST = r"^[a-z][a-z0-9+.\-]*://([^/?#@]*@)?([^/?#:@]+)"
BLOCKED = ("error",)


def host_of(url: Column) -> Column:
    return F.regexp_extract(ascii_lower(F.coalesce(url, F.lit(""))), HOST, 2)


def domains_of(host: Column) -> Column:
    """The host and its parents, down to two labels."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def validity(entries: DataFrame) -> DataFrame:
    """From (domain, since, category): (domain, since, until, category), until NULL if it still holds."""
    entries = (entries.filter("domain is not null and since is not null")
               .groupBy("domain", "since").agg(F.max("category").alias("category")).withColumn("day", F.to_date("since")))
    entries = materialise(entries, "list-entries")
    inside = F.lead("since").over(W.partitionBy("domain", "day").orderBy("since"))
    days = entries.groupBy("domain", "day").agg(F.min("since").alias("first"))
    days = days.select("domain", "day", F.lead("first").over(W.partitionBy("domain").orderBy("day")).alias("next_day"))
    return (entries.withColumn("inside", inside).join(days, ["domain", "day"])
            .select("domain", "since", F.coalesce("inside", "next_day").alias("until"), "category"))


def verdicts(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """From captures (host, fetched): (host, fetched, listed, category) of those under an entry."""
    asked = materialise(captures.filter("host <> '' and fetched is not null").select("host", "fetched").distinct(), "list-asked")
    asked = asked.select("host", "fetched", F.to_date("fetched").alias("day"), F.explode(domains_of(F.col("host"))).alias("domain"))
    last = F.lit(asked.agg(F.max("day")).first()[0]).cast("date")
    pieces = (validity(entries).filter(F.to_date("since") <= last)
              .withColumn("end_day", F.least(F.to_date("until"), last))      # least() skips NULL
              .withColumn("day", F.explode(F.sequence(F.to_date("since"), F.col("end_day")))))
    here = asked.join(pieces, ["domain", "day"]).filter((F.col("since") <= F.col("fetched")) & (
        F.col("until").isNull() | (F.col("fetched") < F.col("until"))))
    return (here.groupBy("host", "fetched").agg(F.max(F.struct(F.length("domain").alias("n"), "domain", "category")).alias("best"))
            .select("host", "fetched", F.col("best.domain").alias("listed"), F.col("best.category").alias("category")))


def filter_captures(captures: DataFrame, entries: DataFrame, *, url_col="url", fetched_col="fetched",
                    blocked: tuple[str, ...] = BLOCKED) -> tuple[DataFrame, dict[str, str]]:
    """`captures` with host, listed, category, kept; and the names of these columns."""
    name = {n: fresh(captures, n) for n in ("host", "listed", "category", "kept")}
    hosted = captures.withColumn(name["host"], host_of(captures[url_col]))
    said = verdicts(hosted.select(F.col(name["host"]).alias("host"), hosted[fetched_col].alias("fetched")), entries)
    inner = {"host": fresh(hosted, "list_host"), "fetched": fresh(hosted, "list_fetched"),
             "listed": name["listed"], "category": name["category"]}
    said = said.withColumnsRenamed(inner)
    judged = hosted.join(said, (hosted[name["host"]] == said[inner["host"]]) &
                         (hosted[fetched_col] == said[inner["fetched"]]), "left").drop(said[inner["host"]], said[inner["fetched"]])
    kept = ~F.coalesce(F.col(name["category"]).isin(*blocked), F.lit(False))
    return judged.withColumn(name["kept"], kept), name


def page_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages as captures: the tables have no fetch time, so one follows from the URL, within 30 days."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    seconds = F.conv(F.substring(F.md5(F.coalesce("url", F.lit("")).cast("binary")), 1, 8), 16, 10).cast("long") % 2_592_000
    return pages.withColumn("fetched", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'") + F.make_dt_interval(secs=seconds.cast("decimal(18,6)")))


def event_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as list entries: an event lists the host of the page with its user's id
    (every second event the domain above it), with the event type as category."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").alias("user_id"), host_of(F.col("url")).alias("host")).filter("host <> ''")
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    above = domains_of(F.col("host"))
    domain = F.when(F.col("event_id") % 2 == 0, F.col("host")).otherwise(F.coalesce(F.get(above, F.lit(1)), F.col("host")))
    return events.join(pages, "user_id").select(domain.alias("domain"), F.col("ts").alias("since"), F.col("event_type").alias("category"))


def judge_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = filter_captures(page_captures(spark, sf_dir), event_entries(spark, sf_dir))
    return judged.select("page_id", "url", "host", "listed", "category", "kept")
