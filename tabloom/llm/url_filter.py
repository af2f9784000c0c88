"""URL rules by hashed host-suffix and path-prefix expressions.

A rule is a host and a path, written as one string (`example.net/en/`). Every URL is
expanded into the strings a rule that fits it could have; rules and expressions meet in an
equi-join on a short prefix of their digest, the full digest confirms the match, and the
longest matching rule decides.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tabloom.llm.common import lower_ascii

SHORT_HEX = 8  # hex digits of the joined digest prefix
MAX_BROADCAST_RULES = 100_000  # more rules are joined by a shuffle
DEFAULT_VERDICT = "allow"


def rules_frame(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs as a table."""
    return spark.createDataFrame(list(rules), "verdict string, rule string")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty without `://` or for null."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("url"))).otherwise("")
    host = lower_ascii(F.regexp_extract(rest, r"^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def _host_suffixes(host: Column) -> Column:
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def _path_prefixes(path: Column, lengths: Sequence[int]) -> Column:
    """Prefixes of `path` at the lengths that rule paths have."""
    fitting = F.filter(F.array(*(F.lit(n) for n in lengths)), lambda n: n <= F.length(path))
    return F.transform(fitting, lambda n: F.substring(path, F.lit(1), n))


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = DEFAULT_VERDICT,
) -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of `pages`.

    A rule fits its host and all subdomains, if the path starts with the rule's; the
    longest fitting rule wins, between equally long ones block, then the smaller rule text.
    Without a fitting rule `rule` is null and the verdict is `default`; so for null and for text
    without `://`, whose host and path are empty. Rules without `/` get the path ''; null rules
    are ignored. Host prefixes are whole labels; nothing limits their number.
    Repeated rows are judged each. Path prefixes are cut at the lengths of rule
    paths, which reach the driver: one number per distinct length.
    """
    named = rules.where(F.col("rule").isNotNull() & F.col("verdict").isNotNull()).select(
        "verdict",
        "rule",
        lower_ascii(F.regexp_extract("rule", "^([^/]*)", 1)).alias("_rule_host"),
        F.regexp_extract("rule", "^[^/]*(.*)$", 1).alias("_rule_path"),
    )
    lengths = sorted(row[0] for row in named.select(F.length("_rule_path")).distinct().collect())
    digest = F.sha2(F.concat_ws("\x00", "_rule_host", "_rule_path"), 256)
    table = named.select(
        "verdict",
        "rule",
        F.length("rule").alias("_long"),
        digest.alias("_digest"),
        F.substring(digest, 1, SHORT_HEX).alias("_short"),
    )
    if table.count() <= MAX_BROADCAST_RULES:
        table = F.broadcast(table)

    host, path = split_url(F.col("url"))
    urls = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")).select(
        "page_id", F.monotonically_increasing_id().alias("_row"), host.alias("host"), path.alias("path")
    )
    expressions = F.flatten(
        F.transform(
            _host_suffixes(F.col("host")),
            lambda h: F.transform(
                _path_prefixes(F.col("path"), lengths), lambda p: F.sha2(F.concat_ws("\x00", h, p), 256)
            ),
        )
    )
    # With the rules at hand in each task the best rule of a URL is chosen without a shuffle.
    opened = urls.withColumn("_own", F.explode_outer(expressions)).withColumn(
        "_own_short", F.substring("_own", 1, SHORT_HEX)
    )
    matched = opened.join(table, F.col("_own_short") == F.col("_short"), "left")
    fits = F.col("_own") == F.col("_digest")
    best = F.min(
        F.when(fits, F.struct((-F.col("_long")).alias("long"), (F.col("verdict") != "block").alias("open"), "rule", "verdict"))
    )
    judged = matched.groupBy("_row", "page_id", "host", "path").agg(best.alias("_best"))
    return judged.select(
        "page_id",
        "host",
        "path",
        F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
