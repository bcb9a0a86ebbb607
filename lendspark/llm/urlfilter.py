"""URL filter: explicit rules, then path templates judged by labelled purity.  DataFrame operations only.

The templates of a host form a tree over path segments.  Level by level, a segment value stays a branch of its own if it has a few
pages and its labelled share of good pages differs from its siblings' by more than chance; all other values (ids, slugs) share the
wildcard branch ``*``.  Levels end where no branch below can differ.  A template is rejected if its
smoothed share of good labelled pages is low; the smoothing leads to the host's share, and that to the share of all pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save

LEVELS = 3  # segments that a template always names; deeper ones are named up to the last branch of its own
SQL_LEVELS = 8  # segments that the SQL tells apart; here there is no limit
MIN_PAGES = 5  # a branch of its own has at least so many pages
DIFFERENT = 1.96  # standard errors between a branch and its siblings, from which they stay apart
STRENGTH = 10.0  # labelled pages that the smoothing counts for
REJECT_BELOW = 0.5


def parse(url: str = "url") -> tuple[Column, Column]:
    """Host and path: after the first ``://`` up to ``/ ? #``, A-Z lower-cased; then up to ``? #``.  Both empty without ``://``."""
    u = F.coalesce(F.col(url).cast("string"), F.lit(""))
    rest = F.when(F.instr(u, "://") > 0, F.expr(f"substring(coalesce(cast(`{url}` as string), ''), instr(coalesce(cast(`{url}` as string), ''), '://') + 3)"))
    rest = rest.otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: list[str]) -> Column:
    """The longest rule ``host/path`` whose host is the url's or a parent domain of it and whose path starts the url's path."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, tail = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + tail)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _branches(at: DataFrame, level: int) -> DataFrame:
    """``at`` with ``template`` longer by the segment of the level, and ``own``: whether that is a branch of its own."""
    at = at.withColumn("segment", F.get("segments", F.lit(level)))
    branch = at.where("segment is not null").groupBy("host", "template", "segment").agg(
        F.count("*").alias("n"), F.count("good").alias("k"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"))
    parent = branch.groupBy("host", "template").agg(F.sum("k").alias("pk"), F.sum("g").alias("pg"))
    pooled = F.col("pg") / F.col("pk")
    error = F.sqrt(pooled * (1 - pooled) * (1 / F.col("k") + 1 / (F.col("pk") - F.col("k"))))
    apart = F.abs(F.col("g") / F.col("k") - (F.col("pg") - F.col("g")) / (F.col("pk") - F.col("k"))) > DIFFERENT * error
    own = branch.join(parent, ["host", "template"]).where(
        (F.col("n") >= MIN_PAGES) & (F.col("k") > 0) & (F.col("pk") > F.col("k")) & apart
    ).select("host", "template", "segment", F.lit(True).alias("own"))
    at = at.join(own, ["host", "template", "segment"], "left")
    step = F.when(F.col("segment").isNull(), F.lit("")).when(F.col("own"), F.concat(F.lit("/"), "segment")).otherwise(F.lit("/*"))
    return at.withColumn("template", F.concat("template", step)).drop("segment")


def templates(pages: DataFrame) -> DataFrame:
    """``pages`` (host, path, good: 1 / 0 / null, and others) with its ``template``.

    Each level is a grouped count and a join back on the branch: counts are summed before they move, and a hot host's pages are
    split by adaptive skew handling, as the small side of the join has one row a branch.  Below the first LEVELS only pages go on whose
    branch has further segments and labels of both kinds, as no other can split; a template then ends with its last branch of its own.
    """
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    at = pages.withColumn("segments", segments).withColumn("template", F.lit(""))
    for level in range(LEVELS):
        at = _branches(at, level).drop("own")
    at, level = save(at.withColumn("named", F.col("template"))), LEVELS
    done = []
    while True:
        mixed = at.where(F.size("segments") > level).groupBy("host", "template").agg(
            F.count("*").alias("n"), F.count("good").alias("k"), F.sum("good").alias("g"))
        mixed = save(mixed.where((F.col("n") > MIN_PAGES) & (F.col("g") > 0) & (F.col("g") < F.col("k"))).select("host", "template", F.lit(True).alias("mixed")))
        if mixed.isEmpty():
            done.append(at)
            break
        on = (F.size("segments") > level) & F.col("mixed").isNotNull()
        at = save(at.join(mixed, ["host", "template"], "left").withColumn("on", F.coalesce(on, F.lit(False))).drop("mixed"))
        done.append(at.where("not on").drop("on"))
        deeper = _branches(at.where("on").drop("on"), level)
        at = save(deeper.withColumn("named", F.when(F.col("own"), F.col("template")).otherwise(F.col("named"))).drop("own"))
        level += 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.withColumn("template", F.col("named")).drop("segments", "named")


def judge(pages: DataFrame, labels: DataFrame, rules: dict[str, str], page: str = "page_id", url: str = "url") -> DataFrame:
    """Per page: page, host, path, rule, template, purity, verdict (the rule's, else allow or block by the template's purity).

    ``labels`` (doc_id, good 1 or 0): a page is labelled by the document that the last all-digit part of its path names; of repeated labels
    the worst counts.  A null or odd url has an empty host and path and the template of those; a template without labelled pages
    has its host's purity, a host without any the overall one, and without labels at all everything is allowed.  Repeated
    rows are judged alike, each kept; extra columns of either table are ignored.
    """
    host, path = parse(url)
    number = F.try_to_number(F.regexp_extract("path", r"^.*?([0-9]{1,18})[^0-9]*$", 1), F.lit("9" * 18)).cast("long")
    known = labels.groupBy("doc_id").agg(F.min("good").alias("good")).where("doc_id is not null")
    rows = pages.select(F.col(page).alias("page"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), list(rules))).withColumn("doc_id", number)
    rows = save(templates(save(rows.join(known, "doc_id", "left").drop("doc_id"))))
    # one row a template, then one a host, then the total: each sums the one before
    by_template = rows.groupBy("host", "template").agg(F.count("good").alias("k"), F.coalesce(F.sum("good"), F.lit(0)).alias("g"))
    by_host = by_template.groupBy("host").agg(F.sum("k").alias("hk"), F.sum("g").alias("hg"))
    k, g = by_host.agg(F.coalesce(F.sum("hk"), F.lit(0)), F.coalesce(F.sum("hg"), F.lit(0))).first()
    overall = g / k if k else 1.0
    prior = (F.col("hg") + STRENGTH * F.lit(overall)) / (F.col("hk") + STRENGTH)
    purity = by_template.join(by_host, "host").select("host", "template", ((F.col("g") + STRENGTH * prior) / (F.col("k") + STRENGTH)).alias("purity"))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("purity") < REJECT_BELOW, "block").otherwise("allow"))
    return rows.join(purity, ["host", "template"], "left").select(
        F.col("page").alias(page), "host", "path", "rule", "template", "purity", verdict.alias("verdict"))


def judge_sql(rules: dict[str, str]) -> str:
    """The judgement in SQL, over ``pages`` and ``labels``, with good = quality 1 and toxic 0.

    It is the same where no branch of its own is deeper than SQL_LEVELS segments.
    """
    case = "NULL"
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        domain, slash, tail = rule.partition("/")
        case = f"CASE WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + tail}') THEN '{rule}' ELSE {case} END"
    verdict = " ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in rules.items())
    levels = ""
    for d in range(1, SQL_LEVELS + 1):
        deep = d > LEVELS
        if deep:
            levels += f"""
, m{d} AS (SELECT host, template, true AS mixed FROM t{d - 1} WHERE alive AND len(segments) >= {d} GROUP BY ALL
           HAVING count(*) > {MIN_PAGES} AND sum(good) > 0 AND sum(good) < count(good))
, w{d} AS (SELECT * EXCLUDE (alive, mixed), alive AND len(segments) >= {d} AND mixed IS NOT NULL AS alive FROM t{d - 1} LEFT JOIN m{d} USING (host, template))"""
        levels += f"""
, a{d} AS (SELECT *, CASE WHEN alive THEN segments[{d}] END AS segment FROM {f"w{d}" if deep else f"t{d - 1}"})
, b{d} AS (SELECT host, template, segment, count(*) AS n, count(good) AS k, coalesce(sum(good), 0) AS g FROM a{d}
           WHERE segment IS NOT NULL GROUP BY ALL)
, p{d} AS (SELECT host, template, sum(k) AS pk, sum(g) AS pg FROM b{d} GROUP BY ALL)
, o{d} AS (SELECT host, template, segment, true AS own FROM b{d} JOIN p{d} USING (host, template)
           WHERE n >= {MIN_PAGES} AND k > 0 AND pk > k
             AND abs(g::DOUBLE / k - (pg - g)::DOUBLE / (pk - k))
                 > {DIFFERENT}::DOUBLE * sqrt(pg::DOUBLE / pk * (1 - pg::DOUBLE / pk) * (1::DOUBLE / k + 1::DOUBLE / (pk - k))))
, t{d} AS (SELECT page_id, host, path, rule, good, segments, alive,
                  template || CASE WHEN segment IS NULL THEN '' WHEN own THEN '/' || segment ELSE '/*' END AS template,
                  CASE WHEN {"own" if deep else "true"} THEN template || CASE WHEN segment IS NULL THEN '' WHEN own THEN '/' || segment ELSE '/*' END
                       ELSE named END AS named
           FROM a{d} LEFT JOIN o{d} USING (host, template, segment))"""
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages)
, h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
, l AS (SELECT doc_id, min((quality = 1 AND toxic = 0)::INT) AS good FROM labels GROUP BY doc_id)
, t0 AS (SELECT page_id, host, path, {case} AS rule, good, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, '' AS template, '' AS named, true AS alive
         FROM h LEFT JOIN l ON l.doc_id = try_cast(regexp_extract(path, '^.*?([0-9]{{1,18}})[^0-9]*$', 1) AS BIGINT)){levels}
, z AS (SELECT page_id, host, path, rule, good, named AS template FROM t{SQL_LEVELS})
, s AS (SELECT host, template, count(good) AS k, coalesce(sum(good), 0) AS g FROM z GROUP BY ALL)
, hs AS (SELECT host, sum(k) AS hk, sum(g) AS hg FROM s GROUP BY ALL)
, o AS (SELECT CASE WHEN sum(hk) > 0 THEN sum(hg)::DOUBLE / sum(hk) ELSE 1.0 END AS overall FROM hs)
, q AS (SELECT host, template, (g + {STRENGTH}::DOUBLE * ((hg + {STRENGTH}::DOUBLE * overall) / (hk + {STRENGTH}::DOUBLE))) / (k + {STRENGTH}::DOUBLE) AS purity
        FROM s JOIN hs USING (host), o)
SELECT page_id, host, path, rule, template, round(purity, 9) AS purity,
       CASE {verdict} WHEN purity < {REJECT_BELOW} THEN 'block' ELSE 'allow' END AS verdict
FROM z JOIN q USING (host, template)
"""
