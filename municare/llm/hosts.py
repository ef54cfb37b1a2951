"""Url filter: listed rules first, else the reputation of the host.

Method: labelled page outcomes (bad or not) are counted per host, registered domain and public suffix.
Beta-binomial shrinkage passes a prior down: the corpus rate is the prior mean of a suffix, the
posterior mean of the suffix that of its domains, that of a domain that of its hosts. The
strength of each prior is estimated from the data by the method of moments over the groups of
that level. A host is blocked when the lower bound of its posterior bad rate lies above the
rate that is allowed. Everything is DataFrame expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.llm.common import stored
from municare.operators.skew import join_facts_back

# (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
ALLOWED_RATE = 0.15  # bad pages of a host that are tolerated
BOUND = 1.0  # standard deviations that the bound lies below the mean
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0  # a prior counts as at least and at most so many pages
# Public suffixes of two labels, "second levels: countries"; a name under them has three labels.
_SECOND_LEVELS = (
    ("ac", "ae at bd be ci cn cr cy fj gn id il im in ir jp ke kr lk ma me mu mw mz ni nz pa pr rs rw se ss sz th tz ug uk vn za zm zw"),
    ("co", "ae ag ao at bb bw ci cl cm cr cz dm gg gl gy hu id il im in ir it je jp ke kr lc ls ma me mg mu mw mz na ni nl nz om pl pn pw rs rw sz th tj tm tt tz ua ug uk us uz ve vi za zm zw"),
    ("com", "ac af ag ai al am ar au aw az ba bb bd bh bi bj bm bn bo br bs bt by bz ci cm cn co cu cv cw cy de dm do dz ec ee eg es et fj fm fr ge gh gi gl gn gp gr gt gu gy hk hn hr ht im in io iq is jo kg ki km kp kw ky kz la lb lc lk lr lv ly mg mk ml mo ms mt mu mv mw mx my na nf ng ni np nr om pa pe pf ph pk pl pr ps pt py qa re ro ru rw sa sb sc sd sg sl sn so ss st sv sy tj tm tn to tr tt tw ua ug uy uz vc ve vi vn vu ws zm"),
    ("edu", "ac af al ar au az ba bb bd bh bi bm bn bo br bs bt bz ci cn co cu cw dm do dz ec ee eg es et fj fm gd ge gh gi gl gn gp gr gt gu gy hk hn ht in iq is it jo kg ki km kp kw ky kz la lb lc lk lr ls lv ly me mg mk ml mn mo ms mt mv mw mx my mz ng ni np nr om pa pe pf ph pk pl pn pr ps pt py qa rs ru rw sa sb sc sd sg sl sn ss st sv sy tj tm to tr tt tw ua uy vc ve vn vu ws za zm"),
    ("gov", "ac ae af al ar as au az ba bb bd bf bh bm bn br bs bt by bz cd cl cm cn co cu cx cy cz dm do dz ec ee eg et fj fk gd ge gh gi gn gr gu gy hk ie il im in iq ir it jo kg ki km kn kp kw ky kz la lb lc lk lr ls lt lv ly ma me mg mk ml mn mo mr ms mu mv mw my mz ng nl np nr om ph pk pl pn pr ps pt py qa rs rw sa sb sc sd sg sl ss st sx sy tj tl tm tn to tr tt tw ua uk vc ve vn ws za zm zw"),
    ("net", "ac ae af ag ai al ar au az ba bb bd bh bm bn bo br bs bt bz ci cm cn co cu cw cy dm do dz ec eg et fj fm ge gg gl gn gp gr gt gu gy hk hn ht id il im in iq ir is je jo kg ki kn kw ky kz la lb lc lk lr ls lv ly ma me mk ml mo ms mt mu mv mw mx my mz nf ng ni np nr nz om pa pe ph pk pl pn pr ps pt py qa rw sa sb sc sd sg sh sl so ss st sy th tj tm tn to tr tt tw ua uk uy uz vc ve vi vn vu ws za zm"),
    ("org", "ac ae af ag ai al ar au az ba bb bd bh bi bm bn bo br bs bt bw bz ci cn co cu cv cw cy dm do dz ec ee eg es et fj fm ge gg gh gi gl gn gp gr gt gu gy hk hn ht hu il im in iq ir is je jo kg ki km kn kp kw ky kz la lb lc lk lr ls lv ly ma me mg mk ml mn mo ms mt mu mv mw mx my mz na ng ni np nr nz om pa pe pf ph pk pl pn pr ps pt py qa ro rs rw sa sb sc sd se sg sh sl sn so ss st sv sy sz tj tm tn to tr tt tw ua ug uk uy uz vc ve vi vn vu ws za zm zw"),
    ("gob", "ar bo cl do ec es gt hn mx ni pa pe pk sv ve"),
    ("mil", "ac ae al ar az ba bo br by cl cn co do ec eg fj ge gh gt hn id in iq jo kg km kr kz lv mg mv my mz ng ni no nz pe ph pl py qa ru rw sh st sy tj tm to tr tw tz uy vc ve ye za zm zw"),
    ("ne", "jp ke kr tz ug us"),
    ("or", "at ci cr id it jp ke kr mu th tz ug us"),
    ("go", "ci cr id it jp ke kr th tj tz ug"),
    ("gouv", "bj ci fr ht km ml rw sn"),
    ("govt", "nz"),
    ("gv", "at ao"),
    ("ad ed gr lg", "jp"),
    ("es hs kg ms pe re sc", "kr"),
    ("ltd me nhs plc police sch", "uk"),
    ("asn id", "au"),
    ("cri geek gen health iwi kiwi maori parliament school", "nz"),
    ("alt law nis nom school web", "za"),
    ("adm adv agr am arq art ato b bio blog bmd cim cng cnt coop des det dev ecn eco emp eng esp etc eti far flog fm fnd fot fst g12 ggf imb ind inf jor jus leg lel log mat med mp mus not ntr odo ppg pro psc psi qsl radio rec rep slg srv taxi tec teo tmp trd tur tv vet vlog wiki zlg", "br"),
    ("firm gen ind nic res", "in"),
    ("idv", "hk tw"),
    ("game club ebiz", "tw"),
    ("in mi", "th"),
    ("biz desa my sch web", "id"),
    ("idf k12 muni", "il"),
    ("asso nom prd tm", "fr"),
    ("av bbs bel biz dr gen info k12 kep name pol tel tsk tv web", "tr"),
    ("int tur", "ar"),
    ("nom", "es"),
    ("biz info waw", "pl"),
    ("in kiev kharkov lviv odessa", "ua"),
    ("per", "sg"),
    ("name", "my"),
)
PUBLIC_SUFFIXES = frozenset(
    f"{second}.{country}" for seconds, countries in _SECOND_LEVELS for second in seconds.split() for country in countries.split()
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; empty without a host part."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""
    rule = verdict = F.lit(None).cast("string")
    for what, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == F.lit(name)) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return rule, verdict


def _bare(host: Column) -> Column:
    """A host without user, port and the dot of the root."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", ""), r"(?<=[^.])\.$", "")


def _is_address(bare: Column) -> Column:
    return bare.rlike(r"^(\d{1,3}\.){3}\d{1,3}$|^\[")


def domain_of(host: Column) -> Column:
    """The registered domain of a host: the public suffix, of one label or one of
    ``PUBLIC_SUFFIXES``, and the label before it. An IP address is whole."""
    bare = _bare(host)
    two = F.regexp_extract(bare, r"([^.]*\.)?[^.]*$", 0)
    three = F.regexp_extract(bare, r"([^.]*\.){0,2}[^.]*$", 0)
    return F.when(_is_address(bare), bare).when(two.isin(*sorted(PUBLIC_SUFFIXES)), three).otherwise(two)


def suffix_of(domain: Column) -> Column:
    """The public suffix of a registered domain; an IP address is its own."""
    two = F.regexp_extract(domain, r"([^.]*\.)?[^.]*$", 0)
    public = two.isin(*sorted(PUBLIC_SUFFIXES))
    return F.when(_is_address(domain), domain).when(public, two).otherwise(F.regexp_extract(domain, r"[^.]*$", 0))


def _strength(groups: DataFrame) -> Column:
    """Prior strength, in pages, of groups with ``n``, ``bad`` and the ``prior`` mean they share.

    Method of moments: of the squared deviation n * (rate - prior)**2 a share is binomial
    noise, prior * (1 - prior); what is above is the spread between the groups.
    """
    prior, n = F.col("prior"), F.col("n")
    noise = F.sum(F.when(n > 0, prior * (1 - prior)))
    deviation = F.sum(F.when(n > 0, n * F.pow(F.col("bad") / n - prior, F.lit(2))))
    size, count = F.sum(n), F.count(F.when(n > 0, 1))
    spread = (deviation - noise) / F.nullif(noise * (size - count) / F.nullif(count, F.lit(0)), F.lit(0.0))
    strength = F.when(spread > 0, 1 / spread - 1).otherwise(F.lit(MOST_STRENGTH))
    bounded = F.greatest(F.lit(LEAST_STRENGTH), F.least(F.lit(MOST_STRENGTH), strength))
    return groups.agg(F.coalesce(bounded, F.lit(MOST_STRENGTH))).scalar()


def reputations(pages: DataFrame) -> DataFrame:
    """Per host of ``pages`` (host, bad: 1, 0 or null): n_pages, n, n_bad, posterior mean and lower
    bound of the bad rate. Without any labelled page all are null."""
    hosts = pages.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
    )
    hosts = hosts.withColumn("domain", domain_of(F.col("host")))
    hosts = stored(hosts.withColumn("suffix", suffix_of(F.col("domain"))), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = stored(domains, "domains")
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = stored(suffixes, "suffixes")

    def posterior(rows: DataFrame) -> DataFrame:
        strength = _strength(rows)
        rows = rows.withColumn("strength", strength)
        mean = (F.col("bad") + F.col("prior") * F.col("strength")) / (F.col("n") + F.col("strength"))
        return rows.withColumn("mean", mean)

    rate = suffixes.agg(F.sum("bad") / F.nullif(F.sum("n"), F.lit(0))).scalar()
    suffixes = stored(posterior(suffixes.withColumn("prior", rate)), "suffixes")
    above = suffixes.select(F.col("suffix").alias("__suffix"), F.col("mean").alias("prior"))
    domains = stored(posterior(stored(domains.join(above, F.col("suffix") == F.col("__suffix")), "domains")), "domains")
    above = domains.select(F.col("domain").alias("__domain"), F.col("mean").alias("prior"))
    hosts = posterior(stored(hosts.join(above, F.col("domain") == F.col("__domain")), "hosts"))
    weight = F.col("n") + F.col("strength")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (weight + 1))
    return hosts.select("host", "n_pages", "n", "bad", "mean", (F.col("mean") - F.lit(BOUND) * deviation).alias("low"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    allowed: float = ALLOWED_RATE,
) -> DataFrame:
    """Per row of ``pages`` (page_id, url): page_id, host, path, rule, verdict, bad_rate, bad_low.

    ``outcomes`` (page_id, bad 0/1): one counts per page, the worst; null ids and nulls are no
    outcome. A null url, or one without ``://``, has empty host and path and is judged with the
    reputation of the empty host. Without any outcome every host is allowed. Repeated pages are
    judged each and count each; other columns are not read.
    """
    known = outcomes.filter("page_id is not null and bad is not null")
    known = known.groupBy(F.col("page_id").alias("__page")).agg(F.max("bad").alias("bad"))
    url = F.col("url")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    rows = stored(rows.join(stored(known, "outcomes"), F.col("page_id") == F.col("__page"), "left").drop("__page"), "urls")
    facts = reputations(rows).select("host", "n_pages", F.col("mean").alias("bad_rate"), F.col("low").alias("bad_low"))
    judged = join_facts_back(rows.select("page_id", "host", "path"), stored(facts, "reputations"), ["host"], "n_pages")
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("bad_low") > F.lit(allowed), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"), "bad_rate", "bad_low"
    )
