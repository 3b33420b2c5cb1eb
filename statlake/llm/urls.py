"""URL filters (operator 8): host and path rules, then a tree of path templates.

Each host has a tree of path segments. Digit runs in a segment become ``#``
and long hexadecimal segments ``#x``. Level by level, the branches below a node whose share of
bad labels does not differ from their siblings' (or that are too few to tell) merge
into one wildcard ``*``; a branch that differs stays. Levels go on as deep as
two templates still share a node; one alone in its node is settled. What is left is a set of
templates. A template is rejected when its labelled purity, smoothed towards its
host's and that towards the whole table's, falls below ``min_purity``.

Native expressions only. All statistics are of distinct templates, counted
before each shuffle, so a host with a third of all pages is a few rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlake.llm.common import pick, stored

#: (verdict, host, path): a rule fits its host and all subdomains
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for NULL or without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct ``(rule, verdict)`` of the longest fitting rule, NULL without one."""
    out = F.lit(None)
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _segments(path: Column) -> Column:
    """The path's generalised segments, each with its slash; none for an empty path."""
    parts = F.split(path, "/", -1)
    wild = lambda seg: F.when(F.rlike(seg, F.lit("^[0-9a-fA-F-]{16,}$")), "#x").otherwise(F.regexp_replace(seg, "[0-9]+", "#"))
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), lambda seg: F.concat(F.lit("/"), wild(seg)))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    min_purity: float = 0.5,
    prior: float = 8.0,
    min_pages: int = 8,
    z: float = 1.96,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` of every page.

    ``labels``: ``page_id, bad`` (0/1; NULL ids or values count as no label,
    repeated ids as bad if one is). ``prior`` is the weight, in labels, of the
    host's share when a template's is smoothed.

    * NULL url, or one without ``://``: host and path are empty; such pages
      share one template, and no rule fits.
    * repeated rows are judged alike and all returned; NULL ``page_id`` stays;
      an empty table gives an empty one, no labels leaves every purity at the
      uninformed prior of 1/2 (allowed); other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    rows = pick(pages, {"page_id": "bigint", "url": "string"}).select("page_id", host.alias("host"), path.alias("path"))
    known = pick(labels, {"page_id": "bigint", "bad": "bigint"}).dropna()
    known = known.groupBy(F.col("page_id").alias("l_id")).agg(F.max("bad").alias("l_bad"))
    rows = rows.join(known, rows.page_id == known.l_id, "left")
    rows = rows.select("page_id", "host", "path", "l_bad", _segments(F.col("path")).alias("segs"))

    sums = lambda df, keys: df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "lab", "bad")])
    count = rows.withColumn("n", F.lit(1)).withColumn("lab", F.when(F.col("l_bad").isNull(), 0).otherwise(1)).withColumn("bad", F.coalesce("l_bad", F.lit(0)))
    live = stored(sums(count, ["host", "segs"]).withColumn("g", F.lit("")), "url-templates")
    settled, k = [], 0
    while True:  # level k: the templates that share their node with others
        node = live.groupBy("host", "g").agg(F.count(F.lit(1)).alias("k"), F.sum("lab").alias("all_lab"), F.sum("bad").alias("all_bad"))
        found = stored(live.join(node, ["host", "g"]), f"url-node{k}")
        rest = F.concat("g", F.array_join(F.slice("segs", k + 1, F.greatest(F.size("segs") - k, F.lit(0))), ""))
        settled.append(found.filter("k = 1").select("host", "segs", "n", "lab", "bad", rest.alias("g")))
        found = found.filter("k > 1").withColumn("s", F.coalesce(F.get("segs", F.lit(k)), F.lit("")))
        if found.isEmpty():
            break
        branch = sums(found, ["host", "g", "s"])
        whole = found.groupBy("host", "g").agg(F.countDistinct("s").alias("k"), F.first("all_lab").alias("all_lab"), F.first("all_bad").alias("all_bad"))
        share = (F.col("all_bad") + 1) / (F.col("all_lab") + 2)
        off = F.col("bad") - F.col("lab") * share
        differs = (F.col("n") >= min_pages) & (off * off > F.lit(z * z) * F.col("lab") * share * (1 - share))
        kept = (F.col("k") == 1) | (F.col("s") == "") | differs
        decided = branch.join(whole, ["host", "g"]).select("host", "g", "s", F.when(kept, F.col("s")).otherwise("/*").alias("to"))
        moved = found.select("host", "segs", "n", "lab", "bad", "g", "s").join(decided, ["host", "g", "s"])
        moved = stored(moved.select("host", "segs", "n", "lab", "bad", F.concat("g", "to").alias("g")), f"url-level{k + 1}")
        settled.append(moved.filter(F.size("segs") <= k))
        live, k = moved.filter(F.size("segs") > k), k + 1
    tree = stored(reduce(DataFrame.unionAll, [d.select("host", "segs", "n", "lab", "bad", "g") for d in settled]), "url-tree")
    per_template = sums(tree, ["host", "g"])
    per_host = sums(tree, ["host"]).select("host", F.col("lab").alias("h_lab"), F.col("bad").alias("h_bad"))
    total = tree.agg(F.sum("bad"), F.sum("lab")).first()  # two numbers
    t = F.lit(((total[0] or 0) + 1) / ((total[1] or 0) + 2))
    smooth = lambda bad, lab, to: (F.col(bad) + F.lit(prior) * to) / (F.col(lab) + F.lit(prior))
    per_host = per_host.select("host", smooth("h_bad", "h_lab", t).alias("h_share"))
    purity = 1 - smooth("bad", "lab", F.col("h_share"))
    found = per_template.join(per_host, "host").select("host", "g", purity.alias("purity"), F.concat("host", "g").alias("template"))
    found = tree.select("host", "segs", "g").join(found, ["host", "g"]).select("host", "segs", "purity", "template")
    fit = longest_rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(found, ["host", "segs"]).withColumn("fit", fit)
    own = F.when(F.col("purity") < min_purity, "block").otherwise("allow")
    verdict = F.coalesce(F.col("fit.verdict"), own)
    return judged.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "template", "purity")


def labels_by_number(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``page_id, bad`` from labels of documents: a page's document is the number
    that its last path segment starts with; bad: quality 0 or toxic 1."""
    urls = pick(pages, {"page_id": "bigint", "url": "string"})
    number = F.regexp_extract(host_and_path(F.col("url"))[1], "/([0-9]+)[^/]*/?$", 1).try_cast("bigint")
    docs = pick(labels, {"doc_id": "bigint", "quality": "bigint", "toxic": "bigint"})
    bad = ((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("bigint")
    docs = docs.filter("quality IS NOT NULL OR toxic IS NOT NULL").groupBy("doc_id").agg(F.max(bad).alias("bad"))
    return urls.select("page_id", number.alias("doc_id")).join(docs, "doc_id").select("page_id", "bad")


def _oracle() -> str:
    """DuckDB SQL for the query: the same definitions, every template taken down to its last segment by recursion."""
    fits = []
    for verdict, h, p in sorted(RULES, key=lambda r: -len(r[1] + r[2])):
        fits.append((f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p, verdict))
    rule = " ".join(f"WHEN {test} THEN '{name}'" for test, name, _ in fits)
    verdict = " ".join(f"WHEN {test} THEN '{v}'" for test, _, v in fits)
    return f"""
WITH RECURSIVE u AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hp AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
dl AS (SELECT doc_id, max((coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1)::INT) AS bad FROM labels
    WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
pl AS (SELECT page_id, max(bad) AS bad FROM (
    SELECT page_id, try_cast(nullif(regexp_extract(path, '/([0-9]+)[^/]*/?$', 1), '') AS BIGINT) AS doc_id FROM hp) JOIN dl USING (doc_id) GROUP BY page_id),
r AS (SELECT page_id, host, path, bad, [
    CASE WHEN regexp_matches(p, '^[0-9a-fA-F-]{{16,}}$') THEN '/#x' ELSE '/' || regexp_replace(p, '[0-9]+', '#', 'g') END
    FOR p IN string_split(path, '/')[2:]] AS segs
    FROM hp LEFT JOIN pl USING (page_id)),
t0 AS (SELECT host, segs, count(*) AS n, count(bad) AS lab, coalesce(sum(bad), 0)::BIGINT AS bad FROM r GROUP BY ALL),
t AS (SELECT host, segs, n, lab, bad, 0 AS lvl, '' AS g FROM t0
    UNION ALL
    SELECT host, segs, n, lab, bad, lvl + 1, g || CASE WHEN one OR s = '' OR (bn >= 8 AND
        (bb - bl * sh) * (bb - bl * sh) > {1.96 * 1.96!r}::DOUBLE * bl * sh * (1 - sh)) THEN s ELSE '/*' END
    FROM (SELECT *, min(s) OVER node = max(s) OVER node AS one, (sum(bad) OVER node + 1) / (sum(lab) OVER node + 2) AS sh,
            (sum(n) OVER branch)::BIGINT AS bn, (sum(lab) OVER branch)::BIGINT AS bl, (sum(bad) OVER branch)::BIGINT AS bb
        FROM (SELECT *, coalesce(segs[lvl + 1], '') AS s FROM t WHERE len(segs) >= lvl)
        WINDOW node AS (PARTITION BY host, g), branch AS (PARTITION BY host, g, s))),
f AS (SELECT host, segs, lab, bad, g FROM t WHERE lvl = len(segs) + 1),
pt AS (SELECT host, g, sum(lab)::BIGINT AS lab, sum(bad)::BIGINT AS bad FROM f GROUP BY ALL),
ph AS (SELECT host, (sum(bad)::BIGINT + 8.0::DOUBLE * (SELECT (sum(bad)::BIGINT + 1) / (sum(lab)::BIGINT + 2) FROM f)) / (sum(lab)::BIGINT + 8.0::DOUBLE) AS hs
    FROM f GROUP BY host),
d AS (SELECT host, segs, host || g AS template, 1 - (pt.bad + 8.0::DOUBLE * hs) / (pt.lab + 8.0::DOUBLE) AS purity
    FROM f JOIN pt USING (host, g) JOIN ph USING (host))
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {verdict} WHEN purity < 0.5 THEN 'block' ELSE 'allow' END AS verdict, template, purity
FROM r JOIN d USING (host, segs)"""


ORACLE = _oracle()
