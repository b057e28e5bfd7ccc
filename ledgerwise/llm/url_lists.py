"""URL filter: a temporal join of captures with dated list entries, DataFrame functions only.

List events (list, action, kind, pattern, dated, verb) become validity
intervals: an entry holds from the day it is added up to the day it is removed.
A capture is judged as of its fetch day, against the entries that hold then:

* ``domain`` entries match the host and all its subdomains,
* ``prefix`` entries match a host followed by a path, up to a segment's end.

Each URL yields its own candidate keys (its host's suffixes and its path's
prefixes), so matching is an equi-join. Intervals are cut into periods of
``PERIOD_DAYS`` days and joined on (key, period), then compared by day: the as-of
condition stays within a key's one period, and a hot host is split by period,
further by adaptive skew splitting. Verdicts depend on (URL, day) only and are
made once for each distinct pair, then joined back to all captures.

Among the entries that hold the longest pattern decides; of equally long ones
an ``allow`` entry, then the first by list name.

Results in odd cases: a capture whose URL or day is null, or whose URL has no
host, matches nothing and is not blocked; events with a null field are ignored;
on one day a removal counts after an addition, repeated events count once; with
no entries nothing is blocked; an empty capture table gives an empty result;
further columns of the captures stay, those named like an added one are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerwise.session import materialize

PERIOD_DAYS = 32
FOREVER = "9999-12-31"


def host_of(url: F.Column) -> F.Column:
    """Lower-cased host without user, port, trailing dot and leading ``www.``; '' if none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)
    return F.regexp_replace(F.regexp_replace(host, r"\.$", ""), r"^www\.", "")


def path_of(url: F.Column) -> F.Column:
    """The path without query and fragment, '' if none."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^?#]*)", 1)


def candidate_keys(url: F.Column) -> F.Column:
    """('domain', suffix) and ('prefix', host/path) keys an entry can match."""
    labels = F.split(host_of(url), r"\.")
    parts = F.filter(F.split(path_of(url), "/"), lambda p: p != "")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.struct(
        F.lit("domain").alias("kind"),
        F.array_join(F.slice(labels, i, F.size(labels)), ".").alias("pattern")))
    prefixes = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda i: F.struct(
        F.lit("prefix").alias("kind"),
        F.concat(host_of(url), F.lit("/"), F.array_join(F.slice(parts, 1, i), "/")).alias("pattern")))
    return F.when(host_of(url) != "", F.concat(domains, F.filter(prefixes, lambda p: ~p["pattern"].endswith("/"))))


def validity_intervals(events: DataFrame) -> DataFrame:
    """(list, verb, kind, pattern, valid_from, valid_to): valid_to is exclusive.
    ``events(list, verb, kind, pattern, dated, action)``: verb is block or allow,
    action add or remove. A day's events are combined first, so a window holds
    at most one row a day."""
    entry = ["list", "verb", "kind", "pattern"]
    days = (events.dropna(subset=[*entry, "dated", "action"]).groupBy(*entry, "dated")
            .agg(F.max("action").alias("action")))  # 'remove' comes after 'add'
    order = W.partitionBy(*entry).orderBy("dated")
    changes = (days.withColumn("before", F.lag("action").over(order))
               .filter(F.col("before").isNull() | (F.col("before") != F.col("action"))))
    spans = changes.withColumn("valid_to", F.coalesce(F.lead("dated").over(order), F.lit(FOREVER).cast("date")))
    return spans.filter("action = 'add'").select(*entry, F.col("dated").alias("valid_from"), "valid_to")


def _period(day: F.Column) -> F.Column:
    return F.floor(F.unix_date(day) / PERIOD_DAYS).cast("int")


def judge(captures: DataFrame, events: DataFrame, url_col: str = "url", day_col: str = "fetched_on") -> DataFrame:
    """``captures`` with blocked, list, pattern (of the deciding entry) and
    n_active (entries that hold and match)."""
    pairs = captures.select(F.col(url_col).alias("url"), F.col(day_col).alias("day")).dropna().distinct()
    keys = (pairs.select("url", "day", _period(F.col("day")).alias("period"), F.explode(candidate_keys(F.col("url"))).alias("k"))
            .select("url", "day", "period", "k.kind", "k.pattern"))
    # open intervals reach no further than the captures do
    reach = captures.agg(F.min(day_col).alias("first"), F.max(day_col).alias("last")).first()
    lo, hi = (F.lit(x).cast("date") for x in reach)
    active = (validity_intervals(events).filter((F.col("valid_to") > lo) & (F.col("valid_from") <= hi))
              .withColumn("period", F.explode(F.sequence(
                  _period(F.greatest("valid_from", lo)), _period(F.least(F.date_sub("valid_to", 1), hi))))))
    hits = (keys.join(active, ["kind", "pattern", "period"])
            .filter((F.col("valid_from") <= F.col("day")) & (F.col("day") < F.col("valid_to"))))
    rank = F.struct((-F.char_length("pattern")).alias("length"), F.col("verb"), F.col("list"), F.col("pattern"))
    verdict = (hits.groupBy("url", "day").agg(F.count("*").alias("n_active"), F.min(rank).alias("first"))
               .select(F.col("url").alias("v_url"), F.col("day").alias("v_day"), "n_active", "first"))
    verdict = materialize(verdict, "url-verdicts")  # so that the join can split a hot URL
    names = [c for c in captures.columns if c not in ("blocked", "list", "pattern", "n_active")]
    rows = captures.select(F.struct(*names).alias("row"))
    joined = rows.join(verdict, (F.col("row")[url_col] == F.col("v_url")) & (F.col("row")[day_col] == F.col("v_day")), "left")
    return joined.select("row.*", F.coalesce(F.col("first.verb") == "block", F.lit(False)).alias("blocked"),
                         F.col("first.list").alias("list"), F.col("first.pattern").alias("pattern"),
                         F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"))


# --- the query's tables: pages have no fetch time and come without lists -----

def page_captures(pages: DataFrame) -> DataFrame:
    """(page_id, url, fetched_on): a fetch day in 2024 and 2025 by page_id."""
    return pages.select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"),
                                                     F.pmod(F.col("page_id") * 37, F.lit(731)).cast("int")).alias("fetched_on"))


def host_events(pages: DataFrame) -> DataFrame:
    """Dated events about the pages' hosts, by the md5 of each pattern: half of
    the hosts are on a block list, most of them for a time, some twice; an eighth
    of the host/language prefixes are allowed from some day on."""
    host = pages.select(host_of(F.col("url")).alias("pattern")).filter("pattern <> ''").distinct()
    lang = (pages.select(host_of(F.col("url")).alias("host"), F.regexp_extract(path_of(F.col("url")), "^/([a-z]+)", 1).alias("lang"))
            .filter("host <> '' and lang <> ''").distinct().select(F.concat_ws("/", "host", "lang").alias("pattern")))

    def digit(i):
        return F.conv(F.substring(F.md5("pattern"), i, 2), 16, 10).cast("int")

    def event(df, kind, verb, days, action):
        return df.select(F.when(digit(3) < 128, "spam").otherwise("ads").alias("list"), F.lit(verb).alias("verb"),
                         F.lit(kind).alias("kind"), "pattern",
                         F.date_add(F.lit("2024-01-01").cast("date"), days).alias("dated"), F.lit(action).alias("action"))

    listed, allowed = host.filter(digit(1) < 128), lang.filter(digit(1) < 32)
    start, length = digit(5), digit(7)
    return (event(listed, "domain", "block", start, "add")
            .unionByName(event(listed.filter(digit(9) < 192), "domain", "block", start + length, "remove"))
            .unionByName(event(listed.filter(digit(9) < 96), "domain", "block", start + length + 60, "add"))
            .unionByName(event(allowed, "prefix", "allow", start, "add")))
