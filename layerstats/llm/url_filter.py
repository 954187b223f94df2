"""URL rules by hash prefix.

A URL is expanded into expressions, a suffix of its host followed by a prefix of
its path that ends in a slash, and these are joined to the rules on the first
bytes of their digests. A full digest and the rest of the rule's path confirm a
hit, and the longest rule decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hexadecimal digits of a digest that the join compares.
PREFIX = 8
#: Shapes of rules up to which only expressions of these shapes are made; beyond, all are.
MOST_SHAPES = 10_000


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, SMALL)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for null."""
    text = F.coalesce(url.cast("string"), F.lit(""))
    at = F.locate("://", text)
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def prepared_rules(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with the expression they are looked up by.

    Of equal rules with different verdicts ``block`` stays. Rules without a host are refused.
    """
    host, path = lower_ascii(F.trim("host")), F.coalesce("path", F.lit(""))
    plain = rules.select(F.when(host != "", host).otherwise(F.raise_error(F.lit("a rule has no host"))).alias("host"), path.alias("path"), "verdict")
    folder = F.regexp_extract("path", r"^(.*/)?", 0)
    return (
        plain.groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
        .withColumn("folder", folder)
        .withColumn("digest", F.sha2(F.concat("host", "folder").cast("binary"), 256))
        .withColumn("prefix", F.substring("digest", 1, PREFIX))
        .withColumn("labels", _count(F.col("host"), ".") + 1)
        .withColumn("slashes", _count(F.col("folder"), "/"))
    )


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` (host and path of the deciding rule, else null) and ``verdict``.

    A rule fits its host and all subdomains if the path begins with the rule's.
    The longest, host and path together, wins; of equally long ones ``block``
    before ``allow``, then the first by name. Only expressions of a shape that
    some rule has (so many host labels, so many slashes) are made, which leaves
    no rule out and bounds the expressions of one URL; with more than ``MOST_SHAPES`` of
    them, all expressions are made. Each distinct URL is judged
    once; null and malformed URLs fit no rule and get ``default``, as do URLs
    without a rule. URLs may be of any length. Repeated rows stay; empty tables of pages give no rows, without
    rules all get ``default``; columns of the added names are replaced, other names do not clash.
    """
    ready = prepared_rules(rules)
    shapes = ready.select("labels", "slashes").distinct().limit(MOST_SHAPES + 1).collect()
    host, path = host_and_path(F.col("__url"))
    urls = pages.select(F.col(url).cast("string").alias("__url")).distinct().withColumns({"__host": host, "__path": path})
    labels, slashes = _count(F.col("__host"), ".") + 1, _count(F.col("__path"), "/")
    first = lambda text, sign, n: F.call_function("substring_index", F.col(text), F.lit(sign), n)
    every = F.transform(
        F.sequence(F.lit(1), labels),
        lambda n: F.transform(
            F.sequence(F.lit(0), slashes),
            lambda m: F.concat(first("__host", ".", -n), F.when(m > 0, F.concat(first("__path", "/", m), F.lit("/"))).otherwise("")),
        ),
    )
    made = F.flatten(every) if len(shapes) > MOST_SHAPES else F.array_compact(
        F.array(
            *(
                F.when(
                    (labels >= s["labels"]) & (slashes >= s["slashes"]),
                    F.concat(
                        F.substring_index("__host", ".", -s["labels"]),
                        F.concat(F.substring_index("__path", "/", s["slashes"]), F.lit("/")) if s["slashes"] else F.lit(""),
                    ),
                )
                for s in shapes
            )
        )
        if shapes
        else F.array().cast("array<string>")
    )
    looked = (
        urls.withColumn("__expression", F.explode_outer(made))
        .withColumn("__digest", F.sha2(F.col("__expression").cast("binary"), 256))
        .withColumn("__prefix", F.substring("__digest", 1, PREFIX))
    )
    r = ready.alias("r")
    # Joined on the short prefix alone; the full digest and the rest of the path confirm.
    hit = (F.col("__digest") == F.col("r.digest")) & F.startswith("__path", F.col("r.path"))
    name = F.concat("r.host", "r.path")
    # The smallest order decides; null, no rule, only where there is nothing else.
    order = F.when(hit, F.struct((-F.length(name)).alias("size"), (F.col("r.verdict") != "block").alias("other"), name.alias("name"), F.col("r.verdict").alias("verdict")))
    best = looked.join(r, F.col("__prefix") == F.col("r.prefix"), "left").groupBy("__url", "__host", "__path").agg(F.min(order).alias("__best"))
    kept = [F.col(f"`{c}`") for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    return pages.join(best, pages[url].cast("string").eqNullSafe(best["__url"]), "left").select(
        *kept,
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        F.col("__best.name").alias("rule"),
        F.coalesce("__best.verdict", F.lit(default)).alias("verdict"),
    )
