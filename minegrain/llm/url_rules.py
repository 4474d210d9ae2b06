"""URL filters: fixed host and path rules, then a tree of path templates judged by smoothed purity of labelled pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from minegrain.llm.common import lower_ascii, stored

# (host and path, verdict). A rule fits its host and all subdomains.
RULES = (
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
)
MAX_RULES = 1000
# Levels of the tree; what lies deeper is one segment of the last level.
DEPTH = 6
# Siblings whose bad shares differ by less standard errors than this are merged.
MERGE_Z = 1.96
# Weight of the parent's share in the share of a branch, in labelled pages.
SMOOTHING = 10.0
REJECT_AT = 0.5


def with_host_and_path(df: DataFrame, url_col: str, host: str = "host", path: str = "path") -> DataFrame:
    """Host: after the first :// up to / ? # or the end, A-Z in lower case. Path: then up to ? or #. Both empty without ://."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)^.*?://", "")).otherwise(F.lit(""))
    return df.withColumn("__rest", rest).withColumns(
        {
            host: lower_ascii(F.regexp_extract("__rest", r"(?s)^[^/?#]*", 0)),
            path: F.regexp_extract("__rest", r"(?s)^[^/?#]*([^?#]*)", 1),
        }
    ).drop("__rest")


def matching_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits (of equally long ones the first by name), and its verdict; null if none fits."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, say in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        name, verdict = F.when(fits, F.lit(rule)).otherwise(name), F.when(fits, F.lit(say)).otherwise(verdict)
    return name, verdict


def segments(path: Column) -> Column:
    """Path segments with runs of digits and long hexadecimal runs generalised; segments below DEPTH are joined."""
    named = F.regexp_replace(F.regexp_replace(path, r"(?i)\b(?=[a-f]*\d)[0-9a-f]{12,}\b", "{x}"), r"\d+", "{n}")
    parts = F.filter(F.split(named, "/"), lambda s: s != "")
    deep = F.array_join(F.slice(parts, DEPTH, 1_000_000), "/")
    return F.when(F.size(parts) > DEPTH, F.concat(F.slice(parts, 1, DEPTH - 1), F.array(deep))).otherwise(parts)


def template_tree(pages: DataFrame) -> DataFrame:
    """(host, segs, template, share): for each generalised path its template and the smoothed bad share of that template.

    `pages` has host, segs, n_lab and n_bad, one row per page. Pages are summed per generalised path before anything else, so
    a host of any size is as many rows as it has different paths. Level by level, children of a branch become the wildcard
    `*` if their bad share does not differ from that of all their siblings by MERGE_Z standard errors; the others stay
    branches of their own, however many siblings they have. The share of a branch is smoothed towards that of its
    parent, from the share of all pages over the host down to the template.
    """
    rows = pages.groupBy("host", "segs").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_lab").alias("n_lab"), F.sum("n_bad").alias("n_bad")
    )
    rows = rows.withColumns({"template": F.lit(""), "share": F.lit(None).cast("double")})
    rows = stored(rows, "paths")
    total = rows.agg(F.sum("n_lab"), F.sum("n_bad")).first()
    overall = ((total[1] or 0) + 1.0) / ((total[0] or 0) + 2.0)
    smooth = lambda bad, n, prior: (bad + SMOOTHING * prior) / (n + SMOOTHING)
    hosts = rows.groupBy("host").agg(smooth(F.sum("n_bad"), F.sum("n_lab"), F.lit(overall)).alias("share"))
    rows = rows.drop("share").join(hosts, "host")
    for level in range(DEPTH):
        child = F.when(F.size("segs") > level, F.element_at("segs", level + 1)).otherwise(F.lit(""))
        rows = rows.withColumn("child", child)
        kids = rows.groupBy("host", "template", "child").agg(F.sum("n_lab").alias("k_lab"), F.sum("n_bad").alias("k_bad"))
        all_kids = kids.groupBy("host", "template").agg(F.sum("k_lab").alias("p_lab"), F.sum("k_bad").alias("p_bad"))
        kids = kids.join(all_kids, ["host", "template"])
        lab, bad = F.col("p_lab") - F.col("k_lab"), F.col("p_bad") - F.col("k_bad")
        pooled = (F.col("p_bad") + 1) / (F.col("p_lab") + 2)
        error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("k_lab") + 1 / lab))
        apart = F.when(
            (F.col("k_lab") > 0) & (lab > 0), F.abs(F.col("k_bad") / F.col("k_lab") - bad / lab) > MERGE_Z * error
        ).otherwise(F.lit(False))
        merged = (F.col("child") != "") & ~apart
        kids = kids.select("host", "template", "child", F.when(merged, F.lit("*")).otherwise(F.col("child")).alias("name"))
        rows = rows.join(kids, ["host", "template", "child"]).drop("child")
        # A path that ends here keeps its template.
        end = F.col("name") == ""
        rows = rows.withColumn(
            "template", F.when(end, F.col("template")).otherwise(F.concat("template", F.lit("/"), "name"))
        ).withColumn("ended", end)
        named = rows.groupBy("host", "template", "ended").agg(F.sum("n_lab").alias("t_lab"), F.sum("n_bad").alias("t_bad"))
        rows = rows.join(named, ["host", "template", "ended"]).withColumn(
            "share", F.when(F.col("ended"), F.col("share")).otherwise(smooth(F.col("t_bad"), F.col("t_lab"), F.col("share")))
        )
        rows = stored(rows.drop("name", "ended", "t_lab", "t_bad"), "tree")
    return rows.select("host", "segs", F.when(F.col("template") == "", "/").otherwise(F.col("template")).alias("template"), "share")


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[tuple[str, str], ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
    label_id: str = "doc_id",
) -> DataFrame:
    """Per row: id, host, path, rule, verdict, template and bad_share.

    A fitting rule decides. Elsewhere the path template of the url is blocked if the smoothed bad share of its labelled pages
    reaches REJECT_AT. `labels` has an id, quality and toxic; a page is bad if its quality is 0 or it is toxic. A page that a
    rule covers counts as labelled by the rule, whatever its own label.

    Null urls and urls without :// have empty host and path and form a template of their own. Null ids and repeated rows are
    judged like any row; several labels of one id count as bad if one of them is. Null quality or toxic says nothing. Without
    any label, shares rest at one half before smoothing and pages without a rule are allowed only below REJECT_AT. An empty
    table gives an empty result; other columns are ignored.
    """
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"))
    rows = with_host_and_path(rows, "__url").drop("__url")
    rule, said = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "said": said, "segs": segments(F.col("path"))})
    bad = labels.select(
        F.col(label_id).alias("__id"),
        F.greatest((F.col("quality") == 0).cast("int"), (F.col("toxic") == 1).cast("int")).alias("bad"),
    )
    bad = bad.filter("bad is not null").groupBy("__id").agg(F.max("bad").alias("bad"))
    ruled = F.when(F.col("said").isNotNull(), (F.col("said") == "block").cast("int"))
    seen = rows.join(bad, "__id", "left").withColumn("bad", F.coalesce(ruled, F.col("bad")))
    tree = template_tree(
        seen.select(
            "host", "segs", F.col("bad").isNotNull().cast("int").alias("n_lab"), F.coalesce("bad", F.lit(0)).alias("n_bad")
        )
    )
    verdict = F.coalesce("said", F.when(F.col("share") >= REJECT_AT, "block").otherwise("allow"))
    return rows.join(tree, ["host", "segs"]).select(
        F.col("__id").alias(id_col), "host", "path", "rule", verdict.alias("verdict"), "template", F.col("share").alias("bad_share")
    )
