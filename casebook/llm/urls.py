"""URL filters: longest-suffix rules, else an empirical-Bayes reputation of the host.

Each page is an observation of its host: bad if a block rule fits it, good if not. Rates shrink through beta-binomial
priors: the suffix towards all pages, the registered domain towards its suffix, the host towards its domain. The
priors' strengths come from the spread of the rates at each level (method of moments). A page that no rule fits is
blocked if the lower posterior bound of its host's bad rate exceeds a limit.

Null urls, and urls without ://, have empty host and path; the empty host has a reputation like any other. Repeated
rows count each, and stay. An empty table gives no row. Columns other than page_id and url are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import join_by_size, materialise

#: The rules of the query: verdict, host, path.
RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
#: Second-level suffixes under which names are registered (fixed values).
SUFFIXES = ["ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "com.sg", "gov.uk", "org.uk"]
Z, LIMIT, PRIOR_LEAST, PRIOR_MOST = 1.64, 0.5, 1.0, 1000.0


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def ruled(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as verdict|rule; null if none does."""
    out = F.lit(None).cast("string")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        out = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(f"{verdict}|{h}{p}")).otherwise(out)
    return out


def _level(rows: DataFrame, key: str, up: str) -> DataFrame:
    """Posterior means of one level: shrink its k of n towards the level above; one pass for the prior's strength.

    The strength is one row, so it is broadcast whatever the number of hosts.
    """
    q = F.col("k") / F.col("n")
    sums = rows.groupBy("one").agg(F.sum("n").alias("tn"), F.sum("k").alias("tk"), F.sum(F.col("k") * q).alias("kq"), F.count(F.lit(1)).alias("groups"))
    p = F.col("tk") / F.col("tn")
    between = F.col("kq") / F.col("tn") - p * p - p * (1 - p) * F.col("groups") / F.col("tn")
    strength = sums.select("one", F.least(F.greatest(p * (1 - p) / F.greatest(between, F.lit(1e-9)) - 1, F.lit(PRIOR_LEAST)), F.lit(PRIOR_MOST)).alias("m"))
    return rows.join(F.broadcast(strength), "one").withColumn(key, (F.col("k") + F.col("m") * F.col(up)) / (F.col("n") + F.col("m")))


def reputation(pages: DataFrame) -> DataFrame:
    """host, n, k (bad pages), bad_low: the lower posterior bound of the bad rate. `pages` has host and bad (0/1).

    Pages are summed by host before anything else moves; domains and suffixes are sums of those sums.
    """
    hosts = materialise(pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("k")).select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "n", "k", F.lit(1).alias("one")))
    add = [F.sum("n").alias("n"), F.sum("k").alias("k"), F.first("one").alias("one")]
    domains = hosts.groupBy("domain", "suffix").agg(*add)
    suffixes = domains.groupBy("suffix").agg(*add)
    total = F.broadcast(suffixes.groupBy("one").agg(((F.sum("k") + 1) / (F.sum("n") + 2)).alias("p0")))
    s = _level(suffixes.join(total, "one"), "ps", "p0").select("suffix", "ps")
    d = _level(domains.join(s, "suffix"), "pd", "ps").select("domain", "pd")
    h = _level(hosts.join(d, "domain"), "mean", "pd")
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("m") + 1))
    return h.select("host", "n", "k", (F.col("mean") - Z * sd).alias("bad_low"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_low."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("fit", ruled(F.col("host"), F.col("path"), rules)).select("page_id", "host", "path", F.substring_index("fit", "|", 1).alias("ruled"), F.expr("substring(fit, instr(fit, '|') + 1)").alias("rule"))
    hosts = materialise(reputation(rows.select("host", F.coalesce((F.col("ruled") == "block").cast("long"), F.lit(0)).alias("bad"))))
    method = F.when(F.col("bad_low") > limit, F.lit("block")).otherwise(F.lit("allow"))
    return join_by_size(rows, hosts.select("host", "bad_low"), ["host"], "left", hosts.count()).select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), F.round("bad_low", 6).alias("bad_low"))


def _sql() -> str:
    r = f"regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1)"
    cases = " ".join(f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{v}|{h}{p}'" for v, h, p in sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r)))
    second = ", ".join(f"'{s}'" for s in SUFFIXES)
    last = lambda n: f"array_to_string(list_slice(string_split(host, '.'), -{n}, -1), '.')"
    strength = lambda rows: f"SELECT least(greatest(p * (1 - p) / greatest(kq / tn - p * p - p * (1 - p) * groups / tn, 1e-9) - 1, {PRIOR_LEAST}), {PRIOR_MOST}) AS m FROM (SELECT sum(n)::DOUBLE AS tn, sum(k)::DOUBLE / sum(n) AS p, sum(k * (k::DOUBLE / n)) AS kq, count(*) AS groups FROM {rows})"
    return f"""
WITH parts AS (SELECT page_id, coalesce(translate({r}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
rows AS (SELECT *, CASE {cases} END AS fit FROM parts),
h0 AS (SELECT host, CASE WHEN {last(2)} IN ({second}) THEN {last(3)} ELSE {last(2)} END AS domain,
  CASE WHEN {last(2)} IN ({second}) THEN {last(2)} ELSE {last(1)} END AS suffix,
  count(*) AS n, count(*) FILTER (fit LIKE 'block|%') AS k FROM rows GROUP BY host),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h0 GROUP BY ALL),
s0 AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM d0 GROUP BY ALL),
p0 AS (SELECT (sum(k)::DOUBLE + 1) / (sum(n) + 2) AS p0 FROM s0),
ms AS ({strength('s0')}), md AS ({strength('d0')}), mh AS ({strength('h0')}),
s AS (SELECT suffix, (k + m * p0) / (n + m) AS ps FROM s0, p0, ms),
d AS (SELECT domain, (k + m * ps) / (n + m) AS pd FROM d0 JOIN s USING (suffix), md),
h AS (SELECT host, mean - {Z} * sqrt(mean * (1 - mean) / (n + m + 1)) AS bad_low FROM (SELECT host, n, m, (k + m * pd) / (n + m) AS mean FROM h0 JOIN d USING (domain), mh))
SELECT page_id, host, path, CASE WHEN fit IS NOT NULL THEN substr(fit, instr(fit, '|') + 1) END AS rule,
  CASE WHEN fit IS NOT NULL THEN split_part(fit, '|', 1) WHEN bad_low > {LIMIT} THEN 'block' ELSE 'allow' END AS verdict, round(bad_low, 6) AS bad_low
FROM rows JOIN h USING (host)"""


SQL = _sql()
