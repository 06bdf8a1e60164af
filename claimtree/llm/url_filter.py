"""URL filter: host-suffix and path-prefix expressions, hash-prefix join, digest check, precedence.

Each URL is expanded into the expressions a rule could be written as: a suffix of its host at label
boundaries with a prefix of its path. Only shapes that some rule has are made, so the number of rows
depends on the rules, not on how long a URL is. Expressions meet rules in an equi-join on a short hash
prefix, and the full digest then confirms them. All of it is built-in functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Hex digits of the digest that the join compares.
PREFIX_DIGITS = 8


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``); '' where there is none."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__u, instr(__u, '://') + 3)"))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit("")), F.coalesce(path, F.lit(""))


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; columns of these names are replaced."""
    host, path = split_url(F.col("__u"))
    return df.withColumn("__u", F.col(url)).withColumns({"host": host, "path": path}).drop("__u")


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """All rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule (host, path, verdict) fits its host and all subdomains if the path starts with the rule's.
    The longest rule wins, of equally long ones the one with the longer host, then ``block``. Without a
    rule, ``rule`` is NULL and the verdict is ``default``. A NULL URL or one without ``://`` has an empty
    host and path and fits no rule. Rules with no host are ignored; a NULL path is an empty one. Repeated
    rows are all returned; other columns pass through, but those named like the four results are replaced.
    Rows with equal URLs are judged once.
    """
    rules = rules.select(
        F.lower("host").alias("r_host"), F.coalesce("path", F.lit("")).alias("r_path"), F.col("verdict").alias("r_verdict")
    ).where(F.length("r_host") > 0)
    rules = rules.groupBy("r_host", "r_path").agg(F.max("r_verdict").alias("r_verdict"))
    # Shapes of rules: as many as there are label counts and path lengths, however many rules there are.
    shapes = rules.agg(
        F.collect_set(F.size(F.split("r_host", r"\."))).alias("labels"), F.collect_set(F.length("r_path")).alias("lengths")
    ).first()
    labels, lengths = (", ".join(map(str, sorted(x))) for x in (shapes.labels, shapes.lengths))

    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    pages = with_parts(pages.select(*kept), url)
    urls = pages.where(F.col("host") != "").select(F.col(url).alias("__url"), "host", "path").distinct()
    forms = f"""flatten(transform(
        filter(cast(array({labels}) as array<int>), c -> c <= size(split(host, '[.]'))),
        c -> transform(
            filter(cast(array({lengths}) as array<int>), l -> l <= length(path)),
            l -> concat(substring_index(host, '.', -c), '\\n', left(path, l)))))"""
    forms = urls.select("__url", F.explode(F.expr(forms)).alias("__form"))
    forms = forms.withColumn("__digest", F.sha2("__form", 256))
    forms = forms.withColumn("__prefix", F.left("__digest", F.lit(PREFIX_DIGITS))).drop("__form")
    known = rules.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
    known = known.withColumn("r_prefix", F.left("r_digest", F.lit(PREFIX_DIGITS)))
    met = forms.join(known, F.col("__prefix") == F.col("r_prefix")).where(F.col("__digest") == F.col("r_digest"))
    rule = F.concat("r_host", "r_path")
    order = F.struct(
        F.length(rule).alias("size"), F.length("r_host").alias("host"),
        F.col("r_verdict").alias("verdict"), rule.alias("rule"),
    )
    best = met.groupBy("__url").agg(F.max(order).alias("__best"))
    joined = pages.join(best, F.col(url) == F.col("__url"), "left")
    return joined.select(
        *kept, "host", "path", F.col("__best.rule").alias("rule"),
        F.coalesce("__best.verdict", F.lit(default)).alias("verdict"),
    )
