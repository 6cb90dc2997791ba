"""URL filter: rules, and empirical-Bayes reputation of hosts, in DataFrame operations only.

Labelled pages have an outcome, good or bad. A host's share of bad pages is shrunk towards its registered domain's, that
towards its public suffix's, and that towards the overall share, each by a beta prior. The strength of a level's prior is
estimated from the beta-binomial overdispersion of its groups by moments: with m the parent's mean, (x - n m)^2 / (n m (1 - m))
is 1 + (n - 1) rho on average. A host is blocked if even the lower bound of its posterior exceeds the share of bad pages overall
times ``most_bad``: if it is worse than the corpus, not only unlucky. Where labels say nothing about hosts, the priors are strong
and no host is blocked. Rules come first: the longest rule that fits decides.

Registered domains
    The suffix is the last label, or the last two where a country's two-letter label follows one of ``SECOND`` (``co.uk``). A public
    suffix list in its own format may be given instead (``suffix_rules`` of its text); such a table isn't part of this library.
    Users, ports and final dots don't count; an IP address is its own domain and suffix.

Edge cases
    Null and scheme-less urls have an empty host and path, and are judged as that host. Hosts without labelled pages get their
    domain's prior. Null outcomes count as unlabelled; of several outcomes of a key a bad one holds. Repeated rows each get a row, and
    count each. Rules of equal length (ties) can't both fit a url unless they are equal. Without labels nothing is blocked but by
    rules. Very long urls are parsed whole. An empty table gives an empty result. Further columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few_rows, join_dimension, materialise

#: (verdict, host and path); at most some hundred: they are part of the plan.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))
#: Labels under which countries register names.
SECOND = ("ac", "co", "com", "edu", "go", "gob", "gov", "mil", "ne", "net", "or", "org")
#: Bounds of the overdispersion, and its value where no group has two labelled pages.
LEAST_RHO, MOST_RHO, NO_RHO = 1e-3, 0.999, 0.5
#: Hosts that are broadcast at most (some 100 bytes each); beyond it pages are joined by a shuffle that deals each host to many tasks.
BROADCAST_HOSTS = 200_000


def _rest(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as a struct (verdict, rule); null if none does."""
    best = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        top, slash, rest = rule.partition("/")
        fits = ((host == top) | F.endswith(host, F.lit("." + top))) & F.startswith(path, F.lit(slash + rest))
        best = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(best)
    return best


def suffix_rules(text: str) -> list[str]:
    """Rules of a public suffix list, names beyond ASCII in their encoded form too."""
    rules = {line.split()[0].lower() for line in text.splitlines() if line.strip() and not line.startswith("//")}
    for rule in [r for r in rules if not r.isascii()]:
        try:
            rules.add(".".join(label if label.isascii() else label.encode("idna").decode() for label in rule.split(".")))
        except UnicodeError:  # a label that the older encoding doesn't know: its plain form stays
            pass
    return sorted(rules)


def site_of(host: Column) -> Column:
    """A host's name without user, port and the dots at its end."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", ""), r"\.+$", "")


def is_address(site: Column) -> Column:
    """IP addresses are no names of labels."""
    return site.rlike(r"^[0-9]+(\.[0-9]+){3}$") | F.startswith(site, F.lit("["))


def _by_rule(hosts: DataFrame) -> DataFrame:
    """Adds suffix and domain by the rule of last labels of site."""
    last = lambda n: F.call_function("substring_index", F.col("site"), F.lit("."), F.lit(-n))
    two = F.regexp_like("site", F.lit(rf"(^|\.)({'|'.join(SECOND)})\.[a-z][a-z]$"))
    return hosts.withColumn("suffix", F.when(two, last(2)).otherwise(last(1))).withColumn("domain", F.when(two, last(3)).otherwise(last(2)))


def with_suffixes(hosts: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """Adds suffix and domain (one label more) to rows of distinct hosts; without ``rules`` by last labels.

    Users, ports and final dots are no part of either; an IP address is its own domain and suffix. In rules of a public suffix list
    ``*.x`` stands for any label before x, ``!x`` is no suffix itself, the longest rule holds; where none fits, the last label is the suffix.
    """
    hosts = hosts.withColumn("site", site_of(F.col("host")))
    named = _by_rule(hosts) if rules is None else _by_list(hosts, rules)
    own = is_address(F.col("site"))
    return named.withColumn("suffix", F.when(own, F.col("site")).otherwise(F.col("suffix"))).withColumn("domain", F.when(own, F.col("site")).otherwise(F.col("domain"))).drop("site")


def _by_list(hosts: DataFrame, rules: list[str]) -> DataFrame:
    """Adds suffix and domain by the rules of a public suffix list."""
    most = max([r.count(".") + 1 for r in rules], default=1)
    line = hosts.sparkSession.range(1).select(F.explode(F.split(F.lit("\n".join(rules)), "\n")).alias("rule"))
    table = line.select(F.regexp_replace("rule", r"^(\*\.|!)", "").alias("tail"), F.startswith("rule", F.lit("*.")).alias("wild"), F.startswith("rule", F.lit("!")).alias("but"))
    last = lambda count, more=0: F.call_function("substring_index", F.col("site"), F.lit("."), -F.col(count) - more)
    labels = F.split("site", r"\.")
    split = hosts.select("host", "site", F.size(labels).alias("all"), F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most)))).alias("k")).withColumn("tail", last("k"))
    length = F.when(F.col("wild"), F.when(F.col("all") > F.col("k"), F.col("k") + 1)).otherwise(F.col("k"))
    found = split.join(F.broadcast(table), "tail").groupBy("host").agg(F.max(F.when(F.col("but"), F.col("k") - 1)).alias("but"), F.max(F.when(~F.col("but"), length)).alias("most"))
    size = F.coalesce("but", "most", F.lit(1))
    return hosts.join(found.select("host", size.alias("labels")), "host", "left").withColumn("labels", F.coalesce("labels", F.lit(1))).withColumn("suffix", last("labels")).withColumn("domain", last("labels", 1)).drop("labels")


def _shrink(level: DataFrame) -> DataFrame:
    """Adds the posterior a, b and its mean to groups with n pages, x of them bad, and prior mean m."""
    parts = level.filter("n > 0").select(
        (F.pow(F.col("x") - F.col("n") * F.col("m"), 2) / (F.col("n") * F.col("m") * (1 - F.col("m"))) - 1).alias("over"), (F.col("n") - 1).alias("more")
    )
    over, more = parts.agg(F.sum("over"), F.sum("more")).first()
    rho = min(max((over or 0.0) / more if more else NO_RHO, LEAST_RHO), MOST_RHO)
    strength = (1 - rho) / rho
    a, b = F.lit(strength) * F.col("m") + F.col("x"), F.lit(strength) * (1 - F.col("m")) + F.col("n") - F.col("x")
    return level.withColumn("a", a).withColumn("b", b).withColumn("mean", F.col("a") / (F.col("a") + F.col("b")))


def reputation(pages: DataFrame, z: float = 1.645, suffixes: list[str] | None = None) -> tuple[DataFrame, float]:
    """host, n, x, mean, lower: posterior of the share of bad pages of hosts, and the overall share. pages: host, bad (null: unlabelled)."""
    sums = [F.sum("n").alias("n"), F.sum("x").alias("x")]
    hosts = pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("x"))
    hosts = materialise(with_suffixes(hosts, suffixes))
    n, x = hosts.agg(*sums).first()
    overall = ((x or 0) + 1) / ((n or 0) + 2)
    suffixes = _shrink(hosts.groupBy("suffix").agg(*sums).withColumn("m", F.lit(overall)))
    domains = _shrink(hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes.select("suffix", F.col("mean").alias("m")), "suffix"))
    full = _shrink(hosts.join(domains.select("domain", F.col("mean").alias("m")), "domain"))
    total = F.col("a") + F.col("b")
    return full.select("host", "n", "x", "mean", (F.col("mean") - z * F.sqrt(F.col("a") * F.col("b") / (total * total * (total + 1)))).alias("lower")), overall


def judge(pages: DataFrame, outcomes: DataFrame, most_bad: float = 1.0, z: float = 1.645, rules=RULES, suffixes: list[str] | None = None) -> DataFrame:
    """One row per row of pages (page_id, url): page_id, host, path, rule, verdict, bad_share. outcomes: key, bad.

    A page's key, by which its outcome is found, is the first number in its path: pages are numbered by the document they show.
    """
    parsed = pages.select("page_id", "url").withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    known = outcomes.filter("key IS NOT NULL AND bad IS NOT NULL").groupBy("key").agg(F.max("bad").alias("bad"))
    keyed = parsed.select("host", F.expr("try_cast(regexp_extract(path, '([0-9]+)', 1) AS bigint)").alias("key"))
    hosts, overall = reputation(keyed.join(known, "key", "left"), z, suffixes)
    hosts = materialise(hosts)
    # few hosts: broadcast; many: each host's pages are dealt out, as one host may have a third of them
    judged = join_dimension(parsed, hosts, "host", few_rows(hosts, BROADCAST_HOSTS), "left").withColumn("r", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("n").isNotNull() & (F.col("lower") > most_bad * overall), F.lit("block")).otherwise(F.lit("allow"))
    return judged.select("page_id", "host", "path", F.col("r.rule").alias("rule"), F.coalesce("r.verdict", own).alias("verdict"), F.col("mean").alias("bad_share"))
