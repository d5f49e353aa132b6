"""URL filter: rules for hosts and paths, and a list of canonical URLs.

Every url yields the keys that an entry could have: its host and all parent domains, each with
the path's beginnings of the lengths that rules have, and its canonical form. A blocked Bloom
filter of all entries stops nearly all keys that have none; an exact hash join settles the rest
and removes false positives. DataFrame code only. Each different url is judged once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow import scratch
from wardflow.llm import bloom

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
TRACKING = r"(?<=[?&])(?:utm_[a-z]+|ref|fbclid|gclid)=[^&]*&?"
MAX_PATH_LENGTHS = 4096  # different lengths of rule paths; a check, rules beyond it are refused


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased. Empty for
    null and for urls without ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without a slash at the end, query without
    tracking parameters; scheme and fragment are left out. Empty where the host is empty."""
    plain = F.regexp_replace(F.regexp_replace(host(url), r"\Awww\.", ""), r":(?:80|443)\z", "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^?#]*(\?[^#]*)", 1)
    kept = F.regexp_replace(F.regexp_replace(query, TRACKING, ""), r"[?&]+\z", "")
    return F.when(plain == "", "").otherwise(
        F.concat(plain, F.regexp_replace(path(url), r"/+\z", ""), kept))


def _domains(host_: Column) -> Column:
    """The host and its parents: ``a.b.c``, ``b.c``, ``c``."""
    labels = F.split(host_, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame, url: str = "url") -> DataFrame:
    """All columns of ``pages`` and: host, path, rule, verdict, listed. Names that clash are
    replaced.

    ``rules`` has host, path, verdict (``allow`` or ``block``): a rule fits its host and all
    subdomains if the path starts with the rule's. The rule with most characters wins; of equal
    ones ``block``. Rules with a null or empty host fit nothing. Where no rule fits, a url whose
    canonical form is that of a row of ``listed`` (column url) is blocked, any other allowed;
    null urls and those without a host are allowed.
    """
    spark = pages.sparkSession
    rule_rows = rules.where(F.col("host").isNotNull() & (F.col("host") != "")).select(
        F.concat(F.translate("host", UPPER, LOWER), F.lit("\n"), F.coalesce("path", F.lit(""))).alias("key"),
        F.concat(F.translate("host", UPPER, LOWER), F.coalesce("path", F.lit(""))).alias("rule"),
        F.col("verdict"))
    urls_listed = listed.select(F.concat(F.lit("\n"), canonical(F.col(listed.columns[0]))).alias("key")).where(
        F.length("key") > 1)
    entries = scratch.materialise(
        rule_rows.unionByName(urls_listed, allowMissingColumns=True)
        .groupBy("key").agg(F.max("rule").alias("rule"), F.max("verdict").alias("verdict")), "url-entries")
    lengths = [r[0] for r in entries.where("rule IS NOT NULL")
               .select((F.length("key") - F.locate("\n", F.col("key"))).alias("n")).distinct()
               .limit(MAX_PATH_LENGTHS + 1).collect()]
    if len(lengths) > MAX_PATH_LENGTHS:
        raise ValueError(f"rules have paths of more than {MAX_PATH_LENGTHS} lengths")
    counted = F.from_json(F.lit(str(sorted(lengths))), "array<int>")

    seen = pages.select(F.col(url).alias("_url")).where(F.col(url).isNotNull()).distinct().select(
        "_url", host(F.col("_url")).alias("_host"), path(F.col("_url")).alias("_path"))
    begins = F.transform(F.filter(counted, lambda n: n <= F.length("_path")),
                         lambda n: F.substring(F.col("_path"), F.lit(1), n))
    keys = F.flatten(F.transform(_domains(F.col("_host")), lambda d: F.transform(
        begins, lambda p: F.concat(d, F.lit("\n"), p))))
    own = F.array(F.concat(F.lit("\n"), canonical(F.col("_url"))))
    candidates = seen.where(F.col("_host") != "").select(
        "_url", F.explode(F.array_distinct(F.concat(keys, own))).alias("key"))
    hits = bloom.possible(candidates, F.col("key"), bloom.build(entries, "key", entries.count()))
    found = hits.join(entries, "key")
    order = F.struct(F.length("rule"), F.col("verdict"))
    best = found.groupBy("_url").agg(
        F.max_by("rule", F.when(F.col("rule").isNotNull(), order)).alias("_rule"),
        F.max_by("verdict", F.when(F.col("rule").isNotNull(), order)).alias("_verdict"),
        F.max(F.col("rule").isNull()).alias("_listed"))
    listed_ = F.coalesce(best["_listed"], F.lit(False))
    names = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict", "listed")]
    return pages.join(best, pages[url] == best["_url"], "left").select(
        *[pages[c] for c in names], host(pages[url]).alias("host"), path(pages[url]).alias("path"),
        best["_rule"].alias("rule"),
        F.coalesce(best["_verdict"], F.when(listed_, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        listed_.alias("listed"))
