"""URL filters: rules for hosts and paths, and trust that spreads over links between hosts.

Everything is DataFrame functions. A rule names a host, with all its subdomains, and the start
of a path; the longest rule that fits decides. Where none fits, the host decides: trust spreads
from hosts whose pages the rules allow along the links, distrust from hosts whose pages they
block against the links (personalised PageRank and its reverse), and a host is blocked if its
distrust reaches `threshold` and exceeds its trust.

A host's seed is the share of its pages that the rules allow, or block; a host with no links
keeps its seed as its score. Links are absolute or protocol-relative `href`s to other hosts.

Defined results: a null url, or one without `://`, has empty host and path; an empty host fits
no rule and has no score, so such a page is allowed. Null html has no links. Each input row
gives one output row; an empty table gives an empty result. Other columns are not carried on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiffin.llm.common import ascii_lower, stored
from tiffin.session import remove_path, work_path

LINK = r"""(?i)href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and every domain it lies in: a.b.c gives a.b.c, b.c, c."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    return F.transform(
        F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n - i + 1), ".")
    )


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): for each host the rules of its domains, longest first.

    `rules` has host, path and verdict. Of rules that agree in host and path one is used, a
    block before an allow.
    """
    unique = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    named = unique.select(
        F.col("host").alias("rule_host"),
        F.struct(
            F.length(F.concat("host", "path")).alias("size"),
            F.concat("host", "path").alias("rule"), "path", "verdict",
        ).alias("entry"),
    )
    parts = hosts.where(F.col("host") != "").select(
        "host", F.explode(F.array_distinct(suffixes(F.col("host")))).alias("rule_host")
    )
    return parts.join(named, "rule_host").groupBy("host").agg(
        F.sort_array(F.collect_list("entry"), asc=False).alias("rules")
    )


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): how often pages of one host link to another host."""
    links = pages.select(
        F.col("host").alias("src"),
        F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), 1)).alias("target"),
    )
    host = F.regexp_replace(ascii_lower(F.col("target")), r"^[^@]*@|:\d*$", "")
    return (
        links.select("src", host.alias("dst"))
        .where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst").agg(F.count("*").alias("n"))
    )


def spread(
    seeds: DataFrame, links: DataFrame, damping: float = 0.85, tolerance: float = 1e-6,
) -> DataFrame:
    """(host, trust, distrust) for every host that the scores reach.

    x = seed + damping * (inflow of x over links), a link's share of its host's outflow being
    its count. Trust flows along the links; distrust against them, over a page's incoming links.
    Rounds end when the largest change is below `tolerance`, and only then: the changes of all
    hosts together shrink by `damping` in each round, so n hosts need at most
    log(n / tolerance) / log(1 / damping) rounds, 250 for 10^12 hosts. Each is written to the
    shared folder, so a lost executor costs one round; the one before the last is removed.
    """
    if not 0 <= damping < 1:
        raise ValueError("damping must be at least 0 and below 1")
    both = links.select("src", "dst", "n", F.lit(1).alias("along")).unionByName(
        links.select(
            F.col("dst").alias("src"), F.col("src").alias("dst"), "n", F.lit(0).alias("along")
        )
    )
    totals = both.groupBy("src", "along").agg(F.sum("n").alias("total"))
    flows = stored(
        both.join(totals, ["src", "along"]).select(
            "src", "dst", "along", (F.lit(damping) * F.col("n") / F.col("total")).alias("share")
        ),
        "url-links",
    )
    state = seeds = stored(seeds.select("host", "trust", "distrust"), "url-seeds")
    if flows.isEmpty():
        return state
    spark, previous = seeds.sparkSession, None
    while True:
        inflow = flows.join(state.withColumnRenamed("host", "src"), "src").select(
            F.col("dst").alias("host"),
            (F.col("along") * F.col("trust") * F.col("share")).alias("trust"),
            ((1 - F.col("along")) * F.col("distrust") * F.col("share")).alias("distrust"),
        )
        raised = inflow.unionByName(seeds).groupBy("host").agg(
            F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")
        )
        old = state.select("host", F.col("trust").alias("t"), F.col("distrust").alias("d"))
        zero = F.lit(0.0)
        path = work_path(spark, "url-round")
        raised.join(old, "host", "left").withColumn(
            "change",
            F.greatest(
                F.abs(F.col("trust") - F.coalesce("t", zero)),
                F.abs(F.col("distrust") - F.coalesce("d", zero)),
            ),
        ).drop("t", "d").write.parquet(path)
        moved = spark.read.parquet(path)
        state = moved.drop("change")
        change = moved.agg(F.max("change")).first()[0]
        if previous is not None:
            remove_path(spark, previous)
        previous = path
        if change is None or change < tolerance:
            return state


def _rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) as literals of the plan, so that no Python worker has to start."""
    rows = [
        F.struct(F.lit(host).alias("host"), F.lit(path).alias("path"), F.lit(v).alias("verdict"))
        for v, host, path in rules
    ]
    if not rows:
        return spark.range(0).select(*[F.lit("").alias(n) for n in ("host", "path", "verdict")])
    return spark.range(1).select(F.inline(F.array(*rows)))


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]], threshold: float = 0.5,
    id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **spreading,
) -> DataFrame:
    """(id, host, path, rule, verdict) per page; `rules` are (allow or block, host, path)."""
    spark = pages.sparkSession
    table = _rule_table(spark, rules)
    url = F.col(url_col)
    split = pages.select(
        F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    counts = stored(split.groupBy("host", "path").agg(F.count("*").alias("n")), "url-paths")
    fitting = stored(rules_of_hosts(counts.select("host").distinct(), table), "url-rules")

    def ruled(rows: DataFrame) -> DataFrame:
        """With `found`, the longest rule whose path starts the row's path."""
        entries = fitting.withColumnRenamed("host", "rule_host")
        path = F.col("path")
        first = F.filter("rules", lambda r: F.startswith(path, r["path"]))
        return rows.join(entries, F.col("host") == F.col("rule_host"), "left").withColumn(
            "found", F.try_element_at(first, F.lit(1))
        ).drop("rules", "rule_host")

    share = lambda verdict: (
        F.sum(F.when(F.col("found.verdict") == verdict, F.col("n")).otherwise(0))
        / F.sum("n")
    )
    seeds = ruled(counts.where(F.col("host") != "")).groupBy("host").agg(
        share("allow").alias("trust"), share("block").alias("distrust")
    )
    links = host_links(pages.select(host_of(url).alias("host"), F.col(html_col).alias("html")))
    scores = spread(seeds, links, **spreading)
    blocked = scores.where(
        (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust"))
    ).select(F.col("host").alias("bad_host"))
    by_host = F.when(F.col("bad_host").isNull(), "allow").otherwise("block")
    return ruled(split).join(blocked, F.col("host") == F.col("bad_host"), "left").select(
        "id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), by_host).alias("verdict"),
    )
