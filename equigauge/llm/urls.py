"""URL filters: host and path rules, and path templates judged by labelled purity.

Rules decide for their host and all its subdomains where the path starts with the
rule's path; the longest wins (longest host, then longest path).

Other urls are judged by a tree of path templates per host. The labels are the
urls that rules decide. Segments that look variable become wildcards at once:
``{n}`` for numbers, ``{t}`` for long tokens with digits. The others are compared
before anything is merged. For each child of a path the share of blocked urls is
tested against that of its siblings (two shares, pooled variance): labelled
branches that are alike are merged into one template ``{x}``, those that differ
stay what they are. A branch without labels has no share to compare. It keeps its
own template; if it is rare it joins the other rare ones without labels in
``{u}``. Only where a path has more than ``MANY`` children whose labels agree are
rare ones taken for values of one variable, labelled or not, and become ``{x}``.

A template is rejected if the smoothed share of blocked urls among its labelled
ones is high enough. Smoothing starts from a fixed share, goes over the domain
(the last two labels of the host) and the host down the template, and evidence
from above counts half at each level; from a node whose branches disagree
nothing is passed down. So a branch without labels is rejected for its parent's
only where they speak clearly and with one voice, and an unknown host is allowed.

All levels of all paths are handled at once, by hashes of their beginnings, so the
number of shuffles does not depend on the depth, and a path costs its own length.
Everything is grouping and joining; a host with a third of all urls is summed
before the shuffle like any other, and only keys and counts are joined.

Defined results: null urls and urls without ``://`` have empty host and path, fit
no rule, and are judged as the host "". Rows with the same page_id are judged
each on its own. Without rules nothing is labelled and every url is allowed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from equigauge.session import materialize

MANY = 50
COMMON_SHARE = 0.05
LEAST_COUNT = 5
PRIOR_WEIGHT = 5.0
PRIOR_SHARE = 0.3
FROM_ABOVE = 0.5
BLOCK_SHARE = 0.5
ALIKE_Z = 1.96


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: str) -> Column:
    """Lower-cased ASCII letters, from after the first :// to the first of / ? # or the end."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: str) -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(rules: list[Rule], host: str = "host", path: str = "path") -> Column:
    """Name of the rule that decides, or null."""
    longest_first = sorted(rules, key=lambda r: (-len(r.host), -len(r.path), r.name))
    out = F.lit(None).cast("string")
    for rule in reversed(longest_first):
        fits = (F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)
        out = F.when(fits & F.col(path).startswith(rule.path), F.lit(rule.name)).otherwise(out)
    return out


def parts(path: str = "path") -> Column:
    """The segments of a path that are not empty, variable ones as wildcards."""
    return F.transform(F.filter(F.split(F.col(path), "/"), lambda s: s != ""), lambda s: F.coalesce(shape(s), s))


def shape(segment: Column) -> Column:
    """{n} for numbers, also with a short extension; {t} for long tokens with digits; null for what may stay as it is."""
    number = segment.rlike(r"^[0-9]+(\.[A-Za-z0-9]{1,5})?$|^[0-9a-fA-F-]{16,}$")
    token = segment.rlike(r"^(?=(?:[^0-9]*[0-9]){4})[A-Za-z0-9_=-]{20,}$")
    return F.when(number, F.lit("{n}")).when(token, F.lit("{t}"))


def chain(segments: str, host: str = "host") -> Column:
    """A hash of every beginning of the segments, from none to all of them, within the host."""
    first = F.array(F.xxhash64(F.col(host)))
    return F.aggregate(F.col(segments), first, lambda ids, s: F.array_append(ids, F.xxhash64(F.element_at(ids, -1), s)))


def unlike(labelled: str, blocked: str, all_labelled: str, all_blocked: str, z: float = ALIKE_Z) -> Column:
    """Whether the share of blocked urls differs from that of all siblings together; null if one side has no labels."""
    rest_l, rest_b = F.col(all_labelled) - F.col(labelled), F.col(all_blocked) - F.col(blocked)
    pooled = F.col(all_blocked) / F.col(all_labelled)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col(labelled) + 1 / rest_l))
    gap = F.abs(F.col(blocked) / F.col(labelled) - rest_b / rest_l)
    return F.when((F.col(labelled) > 0) & (rest_l > 0), gap > z * spread)


def compared(children: DataFrame) -> DataFrame:
    """Children (host, parent, ..., n_labelled, n_blocked) with ``differs``, and ``agree`` of all labelled siblings.

    A child is compared with its siblings as one group, so a node with very many
    children needs no pairs of them.
    """
    keys = ["host", "parent"]
    totals = children.groupBy(*keys).agg(F.sum("n_labelled").alias("l_all"), F.sum("n_blocked").alias("b_all"), F.count("*").alias("n_children"))
    each = children.join(totals, keys).withColumn("differs", F.coalesce(unlike("n_labelled", "n_blocked", "l_all", "b_all"), F.lit(False)))
    each = materialize(each.drop("l_all", "b_all"), "url-children")
    agreed = each.groupBy(*keys).agg((~F.bool_or("differs")).alias("agree"))
    return each.join(agreed, keys)


def templates(paths: DataFrame) -> DataFrame:
    """Adds template, an array of segments and wildcards. ``paths``: host, key, url_parts, n, n_labelled, n_blocked; distinct paths."""
    zipped = F.arrays_zip(F.col("url_parts").alias("segment"), F.slice("ids", 1, F.size("url_parts")).alias("parent"))
    steps = paths.withColumn("ids", chain("url_parts")).select("host", "key", "n", "n_labelled", "n_blocked", F.posexplode(zipped).alias("level", "s"))
    steps = steps.select("host", "key", "level", "s.parent", "s.segment", "n", "n_labelled", "n_blocked")
    children = steps.groupBy("host", "parent", "segment").agg(*[F.sum(c).alias(c) for c in ("n", "n_labelled", "n_blocked")])
    sizes = children.groupBy("host", "parent").agg(F.sum("n").alias("n_parent"))
    judged = compared(children).join(sizes, ["host", "parent"])
    rare = (F.col("n") < LEAST_COUNT) | (F.col("n") < COMMON_SHARE * F.col("n_parent"))
    variable = rare & (F.col("n_children") > MANY) & F.col("agree")
    own = (
        F.when(F.col("segment").isin("{n}", "{t}") | F.col("differs") | (F.col("n_children") == 1), F.col("segment"))
        .when(variable | (F.col("n_labelled") > 0), F.lit("{x}"))
        .when(rare, F.lit("{u}"))
        .otherwise(F.col("segment"))
    )
    decided = judged.select("host", "parent", "segment", own.alias("own"))
    named = steps.select("host", "key", "level", "parent", "segment").join(decided, ["host", "parent", "segment"])
    whole = named.groupBy("host", "key").agg(F.array_sort(F.collect_list(F.struct("level", "own"))).alias("steps"))
    out = paths.select("host", "key", "n_labelled", "n_blocked").join(whole, ["host", "key"], "left")
    template = F.coalesce(F.transform("steps", lambda s: s["own"]), F.array().cast("array<string>"))
    return out.withColumn("template", template).drop("steps")


def template_nodes(tree: DataFrame) -> DataFrame:
    """Every node of the template trees: host, parent (null for the root), node, n_labelled, n_blocked, agree (of the siblings)."""
    ids = chain("template")
    ends = F.arrays_zip(F.concat(F.array(F.lit(None).cast("bigint")), F.slice("ids", 1, F.size("template"))).alias("parent"), F.col("ids").alias("node"))
    each = tree.withColumn("ids", ids).select("host", "n_labelled", "n_blocked", F.inline(ends))
    nodes = each.groupBy("host", "parent", "node").agg(F.sum("n_labelled").alias("n_labelled"), F.sum("n_blocked").alias("n_blocked"))
    nodes = materialize(nodes, "url-nodes")
    below = compared(nodes.where("parent IS NOT NULL")).select("host", "parent", "node", "n_labelled", "n_blocked", "agree")
    return below.unionByName(nodes.where("parent IS NULL").withColumn("agree", F.lit(True)))


def domain_of(host: str = "host") -> Column:
    """The last two labels of a host."""
    return F.substring_index(F.col(host), ".", -2)


def judge(pages: DataFrame, rules: list[Rule], block_share: float = BLOCK_SHARE, prior_weight: float = PRIOR_WEIGHT) -> DataFrame:
    """page_id, host, path, rule, template, purity, verdict of every url."""
    by_rule = F.create_map(*[F.lit(x) for r in rules for x in (r.name, r.verdict)])[F.col("rule")] if rules else F.lit(None).cast("string")
    parsed = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    parsed = parsed.withColumn("rule", rule_of(rules)).withColumn("by_rule", by_rule).withColumn("url_parts", parts())
    parsed = materialize(parsed.withColumn("key", F.element_at(chain("url_parts"), -1)), "urls")
    blocked = F.coalesce(F.col("by_rule") == "block", F.lit(False)).cast("long")
    distinct = parsed.groupBy("host", "key", "url_parts").agg(
        F.count("*").alias("n"), F.count("by_rule").alias("n_labelled"), F.sum(blocked).alias("n_blocked")
    )
    tree = templates(materialize(distinct, "url-paths")).withColumn("template_key", F.element_at(chain("template"), -1))
    tree = materialize(tree, "url-templates")
    nodes = materialize(template_nodes(tree), "url-nodes")
    domains = nodes.where("parent IS NULL").groupBy(domain_of().alias("domain")).agg(F.sum("n_labelled").alias("l_domain"), F.sum("n_blocked").alias("b_domain"))

    def smoothed(blocked: Column, labelled: Column, above: Column) -> Column:
        prior = PRIOR_SHARE + FROM_ABOVE * (above - PRIOR_SHARE)
        return (blocked + prior_weight * prior) / (labelled + prior_weight)

    purity_domain = smoothed(F.col("b_domain"), F.col("l_domain"), F.lit(PRIOR_SHARE))
    # purity depends on the template only, and templates are few next to urls
    chains = tree.groupBy("host", "template_key", "template").agg(F.count("*").alias("n_paths"))
    chains = chains.select("host", "template_key", F.posexplode(chain("template")).alias("level", "node"))
    chains = chains.join(nodes.select("host", "node", "n_labelled", "n_blocked", "agree"), ["host", "node"])
    steps = F.array_sort(F.collect_list(F.struct("level", "n_labelled", "n_blocked", "agree")))
    of_template = chains.groupBy("host", "template_key").agg(steps.alias("steps"))
    of_template = of_template.withColumn("domain", domain_of()).join(domains, "domain")

    def down(p: Column, s: Column) -> Column:
        return smoothed(s["n_blocked"], s["n_labelled"], F.when(s["agree"], p).otherwise(F.lit(PRIOR_SHARE)))

    of_template = of_template.select("host", "template_key", F.aggregate("steps", purity_domain, down).alias("purity"))
    written = F.concat(F.when(F.size("template") > 0, F.lit("/")).otherwise(F.lit("")), F.array_join("template", "/")).alias("template")
    of_url = tree.select("host", "key", "template_key", written).join(of_template, ["host", "template_key"])
    out = parsed.join(materialize(of_url, "url-verdicts"), ["host", "key"])
    own = F.when(F.col("purity") >= block_share, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", "rule", "template", "purity", F.coalesce("by_rule", own).alias("verdict"))
