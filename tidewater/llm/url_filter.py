"""URL filters whose lists change over time.

A list is a history of dated entries: on a day, a value was added or removed.  Per list and value these become
validity intervals [valid_from, valid_to).  Every capture is joined as of its fetch day with the intervals of
its host, its host's parent domains and its host's first path section; the most specific active entry decides, and
an allowing entry beats a blocking one of the same value.

Captures of one host, section and day have one verdict, so they are brought together before anything is
shuffled by host: a host that holds a third of all captures is as many rows as it has sections and days.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
SECTION = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^/?#]+)"


def intervals(entries: DataFrame) -> DataFrame:
    """(list, value, valid_from, valid_to) from dated entries (list, value, day, action 'add' or 'remove').

    valid_to is the first day on which it no longer holds, null if it still does.  Of several entries of one list,
    value and day, a removal counts.  Entries with a null in any of these, or another action, count as none.
    """
    daily = entries.select("list", F.lower("value").alias("value"), "day", "action").dropna().where(
        F.col("action").isin("add", "remove")).groupBy("list", "value", "day").agg(F.max("action").alias("action"))
    history = Window.partitionBy("list", "value").orderBy("day")  # of one row per day at most
    return daily.withColumn("valid_to", F.lead("day").over(history)).where("action = 'add'").select(
        "list", "value", F.col("day").alias("valid_from"), "valid_to")


def with_keys(captures: DataFrame, url_col: str = "url") -> DataFrame:
    """captures with host (lower case) and section; null without a scheme and host."""
    host = F.lower(F.regexp_extract(url_col, HOST, 1))
    section = F.regexp_extract(url_col, SECTION, 1)
    return captures.withColumns({"host": F.when(host != "", host), "section": F.when(section != "", section)})


def temporal_filter(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
                    day_col: str = "fetched_on") -> DataFrame:
    """One row per capture: id, host, fetch day, n_active entries, blocked, and the list, value and interval that decide.

    A capture without host or day has no active entry and isn't blocked.  Repeated captures stay as often as they are.
    Values are host names (which cover their subdomains) or host/section, compared in lower case.
    """
    rows = with_keys(captures.select(F.col(id_col).alias("capture"), F.col(url_col).alias("url"),
                                     F.col(day_col).cast("date").alias("day")))
    rows = rows.select("capture", "host", F.coalesce("section", F.lit("")).alias("section"), "day")
    places = rows.select("host", "section", "day").dropna().distinct()
    labels = F.split("host", r"\.")
    suffixes = F.expr("transform(sequence(1, size(labels)), i -> concat_ws('.', slice(labels, i, size(labels))))")
    keyed = places.withColumn("labels", labels).withColumn("values", F.concat(
        F.when(F.col("section") != "", F.array(F.concat_ws("/", "host", F.lower("section")))).otherwise(F.array().cast("array<string>")),
        suffixes)).select("host", "section", "day", F.explode("values").alias("value"))
    found = keyed.join(intervals(entries), "value").where(
        (F.col("valid_from") <= F.col("day")) & (F.col("valid_to").isNull() | (F.col("day") < F.col("valid_to"))))
    # the longest value is the most specific; of one value, allow stands before block
    rank = F.struct(F.length("value").alias("size"), (F.col("list") == "allow").alias("allows"), "list", "value",
                    "valid_from", "valid_to")
    verdicts = found.groupBy("host", "section", "day").agg(F.count(F.lit(1)).alias("n_active"), F.max(rank).alias("top"))
    out = rows.join(verdicts, ["host", "section", "day"], "left")
    return out.select(F.col("capture").alias(id_col), "host", F.col("day").alias(day_col),
                      F.coalesce("n_active", F.lit(0).cast("bigint")).alias("n_active"),
                      F.coalesce(F.col("top.list") != "allow", F.lit(False)).alias("blocked"), F.col("top.list").alias("list"),
                      F.col("top.value").alias("entry"), F.col("top.valid_from").alias("valid_from"),
                      F.col("top.valid_to").alias("valid_to"))
