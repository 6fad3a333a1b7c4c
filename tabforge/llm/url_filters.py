"""URL filter by a path-template tree.

Per host, path segments are generalised level by level: digits, hex strings and
segments that hardly ever repeat under their parent become wildcards. Sibling
templates whose labelled block rates do not differ are merged. A template is
rejected when its smoothed share of blocked labels is high enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.llm.common import table, written

#: (host, path, verdict): fits the host and its subdomains where the path starts with ``path``.
RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block")]
#: Levels of the tree; deeper segments are one tail wildcard, so that a path costs the same at any length.
LEVELS = 4


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, else nulls. Rules are a fixed list, so this needs no join."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def shape(segment: Column) -> Column:
    """Segments that vary by their spelling alone: numbers and long hex strings, with or without an extension."""
    return (F.when(segment.rlike(r"^[0-9]+(\.[A-Za-z]{1,5})?$"), F.regexp_replace(segment, "^[0-9]+", "{n}"))
            .when(segment.rlike(r"^[0-9a-fA-F-]{16,}$"), F.lit("{x}")).otherwise(segment))


def templates(urls: DataFrame, min_children: int = 20, max_repeat: float = 2.0) -> DataFrame:
    """``urls`` (host, path) with a ``template`` column.

    One level at a time: a node whose children number at least ``min_children``
    and occur at most ``max_repeat`` times on average has its children replaced
    by one wildcard. Counts combine before the shuffle, so one host may hold any
    share of the rows.
    """
    raw = F.filter(F.split("path", "/"), lambda s: s != "")
    tree = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages")).withColumn("raw", raw).select(
        "host", "path", "pages", F.lit("").alias("template"),
        *[F.coalesce(shape(F.get("raw", F.lit(i))), F.lit("")).alias(f"s{i}") for i in range(LEVELS)],
        F.when(F.size("raw") > LEVELS, "/**").otherwise("").alias("tail"))
    for i in range(LEVELS):
        child = F.col(f"s{i}")
        kids = tree.where(child != "").groupBy("host", "template", child.alias("kid")).agg(F.sum("pages").alias("n"))
        wide = kids.groupBy("host", "template").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("n")).where(
            (F.col("kids") >= min_children) & (F.col("n") <= max_repeat * F.col("kids"))).select("host", "template", F.lit(True).alias("wide"))
        tree = tree.join(wide, ["host", "template"], "left").withColumn(
            "template", F.concat("template", F.when(child == "", "").when(F.col("wide") & ~child.startswith("{"), "/*").otherwise(F.concat(F.lit("/"), child)))).drop("wide", f"s{i}")
    return tree.select("host", "path", F.concat("template", "tail").alias("template"))


def judged(labelled: DataFrame, alpha: float = 2.0, z_same: float = 1.96, reject_at: float = 0.8) -> DataFrame:
    """Per (host, template): ``purity`` and ``reject``.

    ``labelled`` has host, template, pages (how many a row stands for) and
    blocked (1, 0, or null without a label). Siblings are the templates with the
    same host and parent; those whose block rate is within ``z_same`` standard
    errors of the siblings' pooled rate are merged and judged together. Purity is
    smoothed by ``alpha`` rows of the rate over all labels.
    """
    known = F.when(F.col("blocked").isNotNull(), F.col("pages")).otherwise(0)
    nodes = labelled.groupBy("host", "template").agg(F.sum(known).alias("n"), F.sum(F.coalesce(F.col("blocked") * F.col("pages"), F.lit(0))).alias("b"))
    nodes = written(nodes.withColumn("parent", F.regexp_replace("template", "/[^/]*$", "")), "url-nodes")
    total = nodes.agg(F.sum("n"), F.sum("b")).first()  # one row
    prior = total[1] / total[0] if total[0] else 0.0
    pooled = nodes.groupBy("host", "parent").agg(F.sum("n").alias("pn"), F.sum("b").alias("pb"))
    # |b - n p| <= z sqrt(n p (1 - p)) with p = pb / pn, squared and times pn^2: integers, so exact.
    off = F.col("b") * F.col("pn") - F.col("n") * F.col("pb")
    alike = (F.col("n") > 0) & (off.cast("double") * off <= z_same**2 * F.col("n") * (F.col("pb") * (F.col("pn") - F.col("pb"))))
    nodes = nodes.join(pooled, ["host", "parent"]).withColumn("branch", F.when(alike, "~").otherwise(F.col("template"))).drop("pn", "pb")
    merged = nodes.groupBy("host", "parent", "branch").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    purity = F.round((F.col("b") + alpha * prior) / (F.col("n") + alpha), 6)
    merged = merged.select("host", "parent", "branch", purity.alias("purity"), ((purity >= reject_at) & (F.col("n") > 0)).alias("reject"))
    return nodes.select("host", "parent", "branch", "template").join(merged, ["host", "parent", "branch"]).select("host", "template", "purity", "reject")


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, template, purity, verdict.

    The rules' verdicts are the labels that the templates learn from. A url that
    no rule fits is blocked when its template is rejected, else allowed. Null
    urls and those without ``://`` have empty host and path and are allowed.
    Repeated rows are judged alike and all returned.
    """
    host, path = url_parts(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, by_rule = rule_columns(F.col("host"), F.col("path"), rules)
    urls = written(urls.withColumn("rule", rule).withColumn("by_rule", by_rule), "urls")
    tree = written(templates(urls.select("host", "path")), "url-tree")
    blocked = F.when(F.col("by_rule").isNotNull(), (F.col("by_rule") == "block").cast("int"))
    labels = urls.groupBy("host", "path").agg(F.count(F.lit(1)).alias("pages"), F.max(blocked).alias("blocked"))
    fitted = tree.join(judged(labels.join(tree, ["host", "path"])), ["host", "template"])
    out = urls.join(fitted, ["host", "path"])
    verdict = F.coalesce("by_rule", F.when(F.col("reject"), "block").otherwise("allow"))
    return out.select("page_id", "host", "path", "rule", "template", "purity", verdict.alias("verdict"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"))


def _sql() -> str:
    up, low = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    fit = [f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN " for h, p, _ in RULES]
    order = sorted(range(len(RULES)), key=lambda i: -len(RULES[i][0] + RULES[i][1]))
    rule = "CASE " + " ".join(f"{fit[i]}'{RULES[i][0]}{RULES[i][1]}'" for i in order) + " END"
    by_rule = "CASE " + " ".join(f"{fit[i]}'{RULES[i][2]}'" for i in order) + " END"
    seg = "CASE WHEN regexp_matches(s, '^[0-9]+([.][A-Za-z]{1,5})?$') THEN regexp_replace(s, '^[0-9]+', '{n}') WHEN regexp_matches(s, '^[0-9a-fA-F-]{16,}$') THEN '{x}' ELSE s END"
    steps, last = [], "t"
    for i in range(1, LEVELS + 1):
        steps.append(f"""k{i} AS (SELECT host, template, count(DISTINCT segs[{i}]) AS kids, sum(pages) AS n FROM {last} WHERE len(segs) >= {i} GROUP BY ALL),
l{i} AS (SELECT x.host, path, pages, segs, raw, x.template || CASE WHEN len(segs) < {i} THEN '' WHEN k.kids >= 20 AND k.n <= 2 * k.kids AND NOT starts_with(segs[{i}], '{{') THEN '/*' ELSE '/' || segs[{i}] END AS template
        FROM {last} x LEFT JOIN k{i} k ON x.host = k.host AND x.template = k.template)""")
        last = f"l{i}"
    return f"""
WITH p AS (SELECT page_id, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '{up}', '{low}'), '') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
u AS (SELECT *, {rule} AS rule, {by_rule} AS by_rule FROM p),
g AS (SELECT host, path, count(*) AS pages, max(CASE by_rule WHEN 'block' THEN 1 WHEN 'allow' THEN 0 END) AS blocked FROM u GROUP BY ALL),
t AS (SELECT host, path, pages, list_filter(string_split(path, '/'), lambda s: s <> '') AS raw,
             list_transform(list_filter(string_split(path, '/'), lambda s: s <> '')[:{LEVELS}], lambda s: {seg}) AS segs, '' AS template FROM g),
{", ".join(steps)},
tree AS (SELECT host, path, template || CASE WHEN len(raw) > {LEVELS} THEN '/**' ELSE '' END AS template FROM {last}),
node AS (SELECT host, template, regexp_replace(template, '/[^/]*$', '') AS parent, coalesce(sum(pages) FILTER (blocked IS NOT NULL), 0) AS n, coalesce(sum(blocked * pages), 0) AS b
         FROM g JOIN tree USING (host, path) GROUP BY host, template),
pool AS (SELECT host, parent, sum(n) AS pn, sum(b) AS pb FROM node GROUP BY ALL),
br AS (SELECT node.*, CASE WHEN n > 0 AND CAST(b * pn - n * pb AS DOUBLE) ** 2 <= CAST(3.8416 AS DOUBLE) * n * (pb * (pn - pb)) THEN '~' ELSE template END AS branch
       FROM node JOIN pool USING (host, parent)),
m AS (SELECT host, parent, branch, sum(n) AS n, round((sum(b) + CAST(2.0 AS DOUBLE) * coalesce((SELECT sum(b) / sum(n) FROM node), 0)) / (sum(n) + CAST(2.0 AS DOUBLE)), 6) AS purity
      FROM br GROUP BY ALL)
SELECT page_id, u.host, u.path, rule, tree.template, purity,
       coalesce(by_rule, CASE WHEN purity >= 0.8 AND m.n > 0 THEN 'block' ELSE 'allow' END) AS verdict
FROM u JOIN tree USING (host, path) JOIN br ON br.host = u.host AND br.template = tree.template
JOIN m ON m.host = br.host AND m.parent = br.parent AND m.branch = br.branch"""


OP5_SQL = _sql()
