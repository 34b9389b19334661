"""URL filtering by rules and by a tree of path templates, with DataFrame expressions only.

Per host, segments of a path that vary become wildcards: numbers, hashes and tokens by their form, and values too rare under
their parent by count. At every level, branches whose children and blocked shares are alike are merged. Templates
are judged by the share of blocked pages among their labelled ones (those that a rule fits), smoothed level by level towards the nodes above them and their host, and a
host's towards a share under which nothing is rejected: so a template is rejected, from one half on, only by labels of its own, of its branch or of its host.
"""

from __future__ import annotations

import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, checkpointed

#: A value stays literal if it has this many pages and this share of its parent's.
LEAST_PAGES, LEAST_SHARE = 3, 0.02
#: Weight of the prior in labelled pages, the prior of a host, and the purity at which a template is rejected. Labels come from rules, most of which block, so
#: their share over all hosts says nothing about a host that has none.
WEIGHT, NEUTRAL, REJECT = 8.0, 0.25, 0.5
#: Branches are merged if their children overlap by this and their shares are within so many standard errors.
OVERLAP, Z = 0.5, 1.96


@dataclass(frozen=True)
class Rule:
    """block or allow pages of a host and its subdomains whose path starts with the rule's."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Both empty for null and for what has no `://`. Only A-Z are lower-cased."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        found = F.when(((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path), F.lit(rule.text)).otherwise(found)
    return found


def shape(path: Column) -> Column:
    """The path with segments that vary by their form replaced."""
    out = F.regexp_replace(path, r"(?<=/)[0-9]+(?=[/.]|$)", "{n}")
    out = F.regexp_replace(out, r"(?<=/)[0-9a-fA-F][0-9a-fA-F-]{15,}(?=[/.]|$)", "{h}")
    return F.regexp_replace(out, r"(?<=/)[^/.{]*[0-9][^/.{]*(?=[/.]|$)", "{x}")


def _segments(rows: DataFrame) -> DataFrame:
    """Adds the segment that each shape has next, `*` for those that are rare under their node, and the one behind it."""
    rows = rows.withColumn("seg", F.get("parts", F.lit(0)))
    own = rows.groupBy("host", "node", "seg").agg(F.sum("n").alias("own"), F.first("all").alias("all"))
    rare = own.where((F.col("own") < LEAST_PAGES) | (F.col("own") < LEAST_SHARE * F.col("all"))).select("host", "node", "seg", F.lit(True).alias("rare"))
    seg = F.when(F.col("rare"), F.lit("*")).otherwise(F.col("seg"))
    return rows.join(rare, ["host", "node", "seg"], "left").withColumn("seg", seg).withColumn("child", F.coalesce(F.get("parts", F.lit(1)), F.lit(""))).drop("rare")


def _classes(rows: DataFrame) -> DataFrame:
    """(host, node, seg, class): branches of a node in order of their commonest child and blocked share, cut where one and the next are not alike.

    Two branches are alike if their children's distributions overlap by OVERLAP and their blocked shares among labelled pages do not differ by more than Z
    standard errors (of the shares' arcsines). A branch without labels is like other such branches only. A node has 1 / LEAST_SHARE + 1 branches at most.
    """
    children = rows.groupBy("host", "node", "seg", "child").agg(*(F.sum(c).alias(c) for c in ("n", "block", "labelled")))
    branch = children.groupBy("host", "node", "seg").agg(
        F.sum("n").alias("pages"), F.sum("block").alias("block"), F.sum("labelled").alias("labelled"), F.max_by("child", F.struct("n", "child")).alias("top")
    )
    share = F.col("block") / F.greatest(F.col("labelled"), F.lit(1))
    branch = branch.select("host", "node", "seg", "pages", "labelled", "top", F.asin(F.sqrt(share)).alias("phi"), (F.col("labelled") > 0).alias("known"))
    order = Window.partitionBy("host", "node").orderBy("known", "top", "phi", "seg")
    before = F.lag(F.struct("seg", "pages", "labelled", "top", "phi", "known")).over(order)
    branch = checkpointed(branch.withColumn("before", before))
    part = lambda seg, name: children.select("host", "node", F.col("seg").alias(seg), "child", F.col("n").alias(name))
    pair = branch.select("host", "node", "seg", "pages", F.col("before.seg").alias("other"), F.col("before.pages").alias("other_pages")).where("other is not null")
    both = pair.join(part("seg", "here"), ["host", "node", "seg"]).join(part("other", "there"), ["host", "node", "other", "child"])
    overlap = both.groupBy("host", "node", "seg").agg(F.sum(F.least(F.col("here") / F.col("pages"), F.col("there") / F.col("other_pages"))).alias("overlap"))
    error = F.sqrt(0.25 / F.greatest(F.col("labelled"), F.lit(1)) + 0.25 / F.greatest(F.col("before.labelled"), F.lit(1)))
    alike = (F.col("known") == F.col("before.known")) & (F.col("top") == F.col("before.top")) & (F.col("overlap") >= OVERLAP) & (F.abs(F.col("phi") - F.col("before.phi")) <= Z * error)
    cut = F.when(F.coalesce(alike, F.lit(False)), 0).otherwise(1)
    numbered = branch.join(overlap, ["host", "node", "seg"], "left").withColumn("class", F.sum(cut).over(order))
    return numbered.select("host", "node", "seg", "class")


def template_purity(pages: DataFrame) -> DataFrame:
    """pages(host, shape, label) -> (host, shape, purity), the purity of the template that each shape belongs to.

    The tree of a host is built level by level, all hosts and nodes together: segments that are rare under their node become `*`, alike branches become one node, whose
    prior is its blocked share among labelled pages, smoothed towards that of the node above (the host's, and at the top NEUTRAL). A node
    that has one shape, or so few pages that every further segment would be rare, needs no further level; and levels at which all shapes of a node go on alike are
    passed in one step, with the prior that their smoothing would give. So there are as many rounds as branchings lie one under the other, however long paths are.
    What ends at a node with the same number of wildcards behind it is one template.
    """
    count = lambda value: F.sum(F.when(F.col("label") == value, 1).otherwise(0))
    shapes = checkpointed(pages.groupBy("host", "shape").agg(F.count("*").alias("n"), count("block").alias("block"), F.count("label").alias("labelled")))
    smoothed = lambda prior: (F.sum("block") + WEIGHT * prior) / (F.sum("labelled") + WEIGHT)
    hosts = shapes.groupBy("host").agg(smoothed(F.lit(NEUTRAL)).alias("prior"))
    parts = F.split(F.substring("shape", 2, 1 << 30), "/")
    open_ = shapes.join(hosts, "host").withColumn("parts", F.when(F.col("shape") == "", F.array().cast("array<string>")).otherwise(parts)).withColumn("node", F.xxhash64("host"))
    closed = []
    while True:
        nodes = open_.groupBy("host", "node").agg(F.sum("n").alias("all"), F.count("*").alias("shapes"), F.sum("block").alias("blocks"), F.sum("labelled").alias("labels"), F.min("parts").alias("low"), F.max("parts").alias("high"))
        ended = (F.col("all") < LEAST_PAGES) | (F.col("shapes") == 1)
        nodes = nodes.select("host", "node", "all", "blocks", "labels", ended.alias("ended"), F.when(ended, 0).otherwise(_common_prefix(F.col("low"), F.col("high"))).alias("skip"))
        open_ = open_.join(nodes, ["host", "node"])
        share = F.col("blocks") / F.greatest(F.col("labels"), F.lit(1))
        passed = share + (F.col("prior") - share) * F.pow(WEIGHT / (F.col("labels") + WEIGHT), F.col("skip"))
        open_ = open_.withColumn("prior", F.when((F.col("skip") > 0) & (F.col("labels") > 0), passed).otherwise(F.col("prior"))).withColumn("parts", F.when(F.col("skip") > 0, F.slice("parts", F.col("skip") + 1, F.size("parts"))).otherwise(F.col("parts")))
        open_ = checkpointed(open_.withColumn("left", F.size("parts")).drop("blocks", "labels", "skip"))
        ends = (F.col("left") <= 0) | F.col("ended")
        closed.append(open_.where(ends).select("host", "shape", "node", "left", "prior", "block", "labelled"))
        rows = _segments(open_.where(~ends))
        if rows.isEmpty():
            break
        rows = checkpointed(rows.drop("all", "ended", "left"))
        classes = checkpointed(_classes(rows))
        rows = rows.join(broadcast_if_small(classes, classes.count(), 100_000), ["host", "node", "seg"])
        priors = rows.groupBy("host", "node", "class").agg(smoothed(F.first("prior")).alias("p"))
        rows = rows.join(priors, ["host", "node", "class"])
        open_ = rows.select("host", "shape", F.slice("parts", F.lit(2), F.size("parts")).alias("parts"), "n", "block", "labelled", F.col("p").alias("prior"), F.xxhash64("node", "class").alias("node"))
    done = checkpointed(reduce(DataFrame.union, closed))
    purity = done.groupBy("host", "node", "left").agg(smoothed(F.first("prior")).alias("purity"))
    return done.join(purity, ["host", "node", "left"]).select("host", "shape", "purity")


def _common_prefix(low: Column, high: Column) -> Column:
    """How many first elements two arrays share: of the least and the greatest of some arrays, those that all share."""
    n = F.least(F.size(low), F.size(high))
    differs = F.array_position(F.zip_with(F.slice(low, F.lit(1), n), F.slice(high, F.lit(1), n), lambda a, b: a == b), F.lit(False))
    return F.when(differs > 0, differs.cast("int") - 1).otherwise(n)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """-> (page_id, host, path, rule, verdict, purity) for every row; purity is that of a rejected template, else null.

    The longest rule that fits decides; other pages are blocked if their template is rejected. Pages are counted by host and form of
    the path with a partial aggregate first, so a host with a third of all pages moves as few rows as any other, and the tree
    is built from those counts. Null urls and urls without `://` have an empty host and path, fit no rule, and
    are judged as a host of their own; repeated rows each give a row.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    rows = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rows = rows.select("*", fitting_rule(F.col("host"), F.col("path"), rules).alias("rule"))
    verdict = F.lit(None).cast("string")
    for rule in rules:
        verdict = F.when(F.col("rule") == rule.text, F.lit(rule.verdict)).otherwise(verdict)
    rows = rows.select("*", verdict.alias("label"), shape(F.col("path")).alias("shape"))
    rejected = checkpointed(template_purity(rows).where(F.col("purity") >= REJECT))
    joined = rows.join(broadcast_if_small(rejected, rejected.count(), 100_000), ["host", "shape"], "left")
    decided = F.coalesce("label", F.when(F.col("purity").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", "rule", decided.alias("verdict"), "purity")
