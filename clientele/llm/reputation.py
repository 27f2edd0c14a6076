"""URL filter: explicit rules first, else the empirical-Bayes reputation of the host. DataFrame operations only.

Labelled outcomes (good or not) are counted by host, registered domain and suffix. Going down from all hosts, the mean of
each level is shrunk towards its parent: mean = (good + s * parent) / (labelled + s). The strength s of each level is the
beta-binomial moment estimate over its members. A host is blocked when the upper bound of its posterior good rate is below
``least``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientele.llm.common import LOWER, UPPER
from clientele.session import checkpointed

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))

# Suffixes of two labels under which names are registered.
TWO_LABEL = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "com.br", "com.cn", "com.mx", "co.in", "co.za", "co.kr", "com.tr", "com.ar", "com.tw")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path; both empty for a null or a text without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, UPPER, LOWER), empty), F.coalesce(path, empty)


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls where none fits."""
    rule = verdict = None
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=True):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith(slash + rest)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def site(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix. A number address, or a host without a dot, is its own domain and suffix."""
    bare = F.regexp_replace(host, r"^.*@|:[0-9]*$", "")
    two = F.regexp_extract(bare, r"[^.]+\.[^.]+$", 0)
    long = two.isin(*TWO_LABEL)
    domain = F.when(long, F.regexp_extract(bare, r"([^.]+\.)?[^.]+\.[^.]+$", 0)).otherwise(two)
    suffix = F.when(long, two).otherwise(F.regexp_extract(bare, r"[^.]+$", 0))
    plain = bare.rlike(r"^[0-9.]+$") | (two == "")
    return F.when(plain, bare).otherwise(domain), F.when(plain, bare).otherwise(suffix)


def _strength(level: DataFrame, parent: Column) -> float:
    """Prior strength of the members of a level around their parents' means, from one row of sums."""
    gap = F.pow(F.col("good") / F.col("labelled") - parent, F.lit(2.0))
    sums = level.where("labelled > 0").agg(
        F.sum(F.col("labelled") * gap / (parent * (1 - parent))).alias("q"), F.count("*").alias("members"), F.sum("labelled").alias("n")
    ).first()
    if not sums["members"] or sums["n"] == sums["members"]:
        return 10.0
    rho = min(0.5, max(0.01, (sums["q"] - sums["members"]) / (sums["n"] - sums["members"])))
    return round(1 / rho - 1, 4)


def reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior of each ``host`` from its counts ``labelled`` and ``good``; other columns stay. Hosts are unique here."""
    counts = [F.sum("labelled").alias("labelled"), F.sum("good").alias("good")]
    domains = checkpointed(hosts.groupBy("domain").agg(F.first("suffix").alias("suffix"), *counts))
    suffixes = domains.groupBy("suffix").agg(*counts)
    total = suffixes.agg(*counts).first()
    top = ((total["good"] or 0) + 1) / ((total["labelled"] or 0) + 2)
    s = _strength(suffixes, F.lit(top))
    shrunk = lambda s, parent: (F.col("good") + F.lit(s) * parent) / (F.col("labelled") + F.lit(s))
    suffixes = suffixes.select("suffix", shrunk(s, F.lit(top)).alias("parent"))
    domains = domains.join(suffixes, "suffix")
    s = _strength(domains, F.col("parent"))
    domains = domains.select("domain", shrunk(s, F.col("parent")).alias("parent"))
    hosts = hosts.join(domains, "domain")
    s = _strength(hosts, F.col("parent"))
    mean = shrunk(s, F.col("parent"))
    return (
        hosts.withColumn("mean", mean)
        .withColumn("upper", F.col("mean") + F.lit(z) * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("labelled") + F.lit(s + 1))))
    )


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, least: float = 0.5, z: float = 1.645, key: str = "page_id", url: str = "url") -> DataFrame:
    """Every row of ``pages`` with host, path, rule, verdict, and the counts and posterior of its host.

    ``outcomes``: ``key`` and ``good`` (0 or 1) of labelled pages; null or missing: not labelled; a page labelled more than
    once is good only if it always is. Null or malformed urls share the empty host. Repeated pages are judged each.

    Hosts with over a thousandth of the rows, fewer than a thousand by that bound, are broadcast; the rows of all others are
    joined by host, and rows already served are spread over the tasks.
    """
    host, path = host_and_path(F.col("url"))
    own = pages.select(F.col(key).alias("page"), F.col(url).alias("url")).select("page", host.alias("host"), path.alias("path"))
    known = outcomes.select(F.col(key).alias("page"), F.col("good").cast("int").alias("good")).where("page is not null and good is not null").groupBy("page").agg(F.min("good").alias("good"))
    domain, suffix = site(F.col("host"))
    hosts = (
        own.join(known, "page", "left").groupBy("host")
        .agg(F.count("good").alias("labelled"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.count("*").alias("pages"))
        .select("*", domain.alias("domain"), suffix.alias("suffix"))
    )
    hosts = checkpointed(hosts)
    total = hosts.agg(F.sum("pages")).first()[0] or 0
    facts = ["labelled", "good", "mean", "upper"]
    found = checkpointed(reputation(hosts, z).select("host", "pages", *facts))
    hot = found.where(F.col("pages") * 1000 > total).select("host", F.struct(*facts).alias("hot"))
    cold = found.where(F.col("pages") * 1000 <= total).select(F.col("host").alias("cold_host"), F.struct(*facts).alias("cold"))
    joined = own.join(F.broadcast(hot), "host", "left")
    spread = F.when(F.col("hot").isNull(), F.col("host")).otherwise(F.concat(F.lit("/"), F.xxhash64("page").cast("string")))
    joined = joined.withColumn("by", spread).join(cold, F.col("by") == F.col("cold_host"), "left").withColumn("fact", F.coalesce("hot", "cold"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    earned = F.when(F.col("fact.upper") < least, "block").otherwise("allow")
    return joined.select(
        F.col("page").alias(key), "host", "path", rule.alias("rule"), F.coalesce(verdict, earned).alias("verdict"),
        F.col("fact.labelled").alias("n_labelled"), F.col("fact.good").cast("long").alias("n_good"),
        F.round("fact.mean", 6).alias("good_rate"), F.round("fact.upper", 6).alias("good_rate_upper"),
    )


def _shrunk(members: str, parent: str) -> str:
    """SQL of one level: strength from ``members`` (labelled, good, parent)."""
    return f"""
  select case when n is null or n = members then 10.0 else round(1 / least(0.5, greatest(0.01, (q - members) / (n - members))) - 1, 4) end as s
  from (select sum(labelled * pow(good / labelled - {parent}, 2) / ({parent} * (1 - {parent}))) as q, count(*) as members, sum(labelled)::double as n from {members} where labelled > 0)"""


_TWO = ", ".join(f"'{x}'" for x in TWO_LABEL)
JUDGE_SQL = f"""
with u as (
  select page_id, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages
), h as (
  select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}'), '') as host,
    coalesce(regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*'), '') as path from u
), r as (
  select *, case
    when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/en/1') then 'example.org/en/1'
    when (host = 'example.org' or host like '%.example.org') and starts_with(path, '/es/') then 'example.org/es/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/fr/') then 'com/fr/'
    when (host = 'com' or host like '%.com') and starts_with(path, '/de/') then 'com/de/'
    when (host = 'org' or host like '%.org') and starts_with(path, '/') then 'org/' end as rule from h
), o as (
  select doc_id as page_id, min((quality = 1 and toxic = 0)::int) as good from labels where doc_id is not null and quality is not null and toxic is not null group by 1
), b as (
  select host, count(o.good)::double as labelled, coalesce(sum(o.good), 0)::double as good, regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', '') as bare
  from h left join o using (page_id) group by host
), s2 as (
  select *, regexp_extract(bare, '[^.]+\\.[^.]+$') as two from b
), hosts as (
  select host, labelled, good,
    case when regexp_matches(bare, '^[0-9.]+$') or two = '' then bare when two in ({_TWO}) then regexp_extract(bare, '([^.]+\\.)?[^.]+\\.[^.]+$') else two end as domain,
    case when regexp_matches(bare, '^[0-9.]+$') or two = '' then bare when two in ({_TWO}) then two else regexp_extract(bare, '[^.]+$') end as suffix from s2
), domains as (select domain, first(suffix) as suffix, sum(labelled) as labelled, sum(good) as good from hosts group by 1
), suffixes as (select suffix, sum(labelled) as labelled, sum(good) as good from domains group by 1
), g as (select (coalesce(sum(good), 0) + 1) / (coalesce(sum(labelled), 0) + 2) as top from suffixes
), m1 as (select suffixes.*, g.top as parent from suffixes, g
), s1 as ({_shrunk("m1", "parent")}
), p1 as (select suffix, (good + s * parent) / (labelled + s) as parent from m1, s1
), m2 as (select domains.*, p1.parent from domains join p1 using (suffix)
), t2 as ({_shrunk("m2", "parent")}
), p2 as (select domain, (good + s * parent) / (labelled + s) as parent from m2, t2
), m3 as (select hosts.*, p2.parent from hosts join p2 using (domain)
), t3 as ({_shrunk("m3", "parent")}
), f0 as (select host, labelled, good, (good + s * parent) / (labelled + s) as mean, s from m3, t3
), f as (select *, mean + 1.645 * sqrt(mean * (1 - mean) / (labelled + s + 1)) as upper from f0)
select page_id, host, path, rule, case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block' when upper < 0.5 then 'block' else 'allow' end as verdict,
  labelled::bigint as n_labelled, good::bigint as n_good, round(mean, 6) as good_rate, round(upper, 6) as good_rate_upper
from r join f using (host)
"""
