"""URL filter by a path-template tree per host; DataFrame functions only.

Paths become templates level by level. Runs of digits are one symbol from the start. Below a node, a
segment turns into the wildcard ``*``

* if the node has at least ``MIN_CHILDREN`` different segments and this one holds less than ``MIN_SHARE``
  of its pages: the position is variable; or
* if its branch is statistically like the node as a whole: what follows it is spread alike (total
  variation distance, with slack for few pages), and its labels do not differ significantly from the
  node's (a proportion test at 5 %). Such branches are merged.

So a node keeps at most ``MIN_CHILDREN + 1 / MIN_SHARE`` segments of its own, whatever the data. A
template's purity is its share of good labels, smoothed towards the node above it, a host towards all
hosts; templates below one half are rejected.

There is no last level: the tree grows until no shape has a further segment. A step first passes all segments
that the shapes of a node have in common at once (an only child is like its node, so each is ``*``), then branches.
So there are as many steps as nodes that branch below each other, however long paths are.

Pages are aggregated to host and shape (path without numbers) before anything else, so a host with a third
of all pages is shuffled as its few shapes; only those tables are joined and windowed. The last join gives
pages their verdict; it is a plain join whose skewed side Spark splits.

Allow and block rules decide first; the longest rule that fits wins, equally long ones by their text. The
pages they decide are the labels of all others.

Defined results: a null url, or one without ``://``, has an empty host and path, and is judged like any
other host. An unlabelled host has the purity of all hosts together, one half without any label.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beneflow.llm.frames import Steps, stored

MIN_CHILDREN = 16
MIN_SHARE = 0.05
DISTANCE = 0.2
SIGNIFICANT = 3.84  # square of the 5 % point of the normal distribution
SMOOTHING = 10.0
PURITY = 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# Fixed values of the contract.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda group: F.coalesce(F.regexp_extract(url, URL, group), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def longest_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """(text, verdict) of the rule that decides, else null."""
    text = verdict = None
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text = F.when(fits, rule.text) if text is None else text.when(fits, rule.text)
        verdict = F.when(fits, rule.verdict) if verdict is None else verdict.when(fits, rule.verdict)
    nothing = F.lit(None).cast("string")
    return (nothing, nothing) if text is None else (text, verdict)


NODE = ["host", "node"]


def _shape(path: Column) -> Column:
    """The segments, each with a slash behind it; numbers are one symbol."""
    parts = F.filter(F.split(F.regexp_replace(path, "[0-9]+", "{n}"), "/", -1), lambda s: s != "")
    return F.array_join(F.transform(parts, lambda s: F.concat(s, F.lit("/"))), "")


def _smoothed(parent: Column) -> Column:
    return (F.col("g") + SMOOTHING * parent) / (F.col("l") + SMOOTHING)


def _passed(shapes: DataFrame) -> DataFrame:
    """Beyond the segments that all shapes of a node begin with; those of the first and last in order show them.

    Smoothing with the same counts k times brings the purity closer to the node's own share by a power of k.
    """
    nodes = shapes.groupBy(*NODE, "purity").agg(
        F.min("rest").alias("low"), F.max("rest").alias("high"), F.sum("good").alias("g"), F.sum("labelled").alias("l")
    )
    low = F.split("low", "/", -1)
    same = F.transform(F.arrays_zip(low.alias("a"), F.split("high", "/", -1).alias("b")), lambda x: x["a"].eqNullSafe(x["b"]))
    differ = F.array_position(same, False)
    # The last element is what follows the last slash: nothing.
    k = F.when(differ > 0, differ - 1).otherwise(F.size(low) - 1).cast("int")
    share = F.try_divide(F.col("g"), F.col("l"))
    nearer = share + (F.col("purity") - share) * F.pow(SMOOTHING / (F.col("l") + SMOOTHING), F.col("k"))
    nodes = nodes.withColumn("k", k).select(
        *NODE, "k", F.length(F.array_join(F.slice(low, F.lit(1), F.col("k")), "/")).alias("passed"),
        F.coalesce(nearer, "purity").alias("purity"),
    )
    return shapes.drop("purity").join(nodes, NODE).select(
        "host", "shape", F.concat("node", F.repeat(F.lit("*/"), F.col("k"))).alias("node"),
        F.when(F.col("k") == 0, F.col("rest")).otherwise(F.substring("rest", F.col("passed") + 2, F.length("rest"))).alias("rest"),
        "n", "good", "labelled", "purity",
    )


def _branched(shapes: DataFrame) -> DataFrame:
    """One level down: the segment itself or ``*`` joins the node; ``ended`` where the path has no further segment."""
    own = F.substring_index("rest", "/", 1)
    shapes = shapes.withColumns({"own": own, "tail": F.substring("rest", F.length(own) + 2, F.length("rest"))})
    tails = shapes.groupBy(*NODE, "own", "tail").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("labelled").alias("labelled")
    )
    branches = tails.groupBy(*NODE, "own").agg(
        F.sum("n").alias("n_b"), F.sum("good").alias("good_b"), F.sum("labelled").alias("labelled_b")
    )
    nodes = branches.groupBy(*NODE).agg(
        F.sum("n_b").alias("n_p"), F.sum("good_b").alias("good_p"), F.sum("labelled_b").alias("labelled_p"),
        F.count("*").alias("children"),
    )
    node_tails = tails.groupBy(*NODE, "tail").agg(F.sum("n").alias("n_t"))
    share_b, share_p = F.col("n") / F.col("n_b"), F.col("n_t") / F.col("n_p")
    # Tails the branch lacks add their whole share of the node.
    distance = (F.sum(F.abs(share_b - share_p)) + 1 - F.sum(share_p)) / 2
    distances = (
        tails.drop("good", "labelled").join(branches, [*NODE, "own"]).join(nodes, NODE).join(node_tails, [*NODE, "tail"])
        .groupBy(*NODE, "own", "n_b", "good_b", "labelled_b", "n_p", "good_p", "labelled_p", "children")
        .agg(distance.alias("distance"))
    )
    rate = F.when(F.col("labelled_p") > 0, F.col("good_p") / F.col("labelled_p")).otherwise(F.lit(0.0))
    off = F.col("good_b") - F.col("labelled_b") * rate
    labels_differ = off * off > F.col("labelled_b") * rate * (1 - rate) * SIGNIFICANT
    variable = (F.col("children") >= MIN_CHILDREN) & (F.col("n_b") < F.col("n_p") * MIN_SHARE)
    alike = (F.col("distance") <= DISTANCE + 1 / F.sqrt("n_b")) & ~labels_differ
    ended = F.col("own") == ""
    below = F.when(variable | alike, "*/").otherwise(F.concat("own", F.lit("/")))
    templates = distances.select(*NODE, "own", "good_b", "labelled_b", F.when(ended, "").otherwise(below).alias("below"))
    # Branches that became one template are one node.
    merged = templates.groupBy(*NODE, "below").agg(F.sum("good_b").alias("g"), F.sum("labelled_b").alias("l"))
    templates = templates.drop("good_b", "labelled_b").join(merged, [*NODE, "below"])
    return shapes.join(templates, [*NODE, "own"]).select(
        "host", "shape", F.concat("node", "below").alias("node"), F.col("tail").alias("rest"), "n", "good", "labelled",
        _smoothed(F.col("purity")).alias("purity"), ended.alias("ended"),
    )


def template_purity(shapes: DataFrame, steps: Steps) -> DataFrame:
    """(host, shape, template, purity) from (host, shape, n, good, labelled) rows."""
    total = shapes.agg(F.sum("good").alias("g"), F.sum("labelled").alias("l")).select(
        ((F.coalesce("g", F.lit(0)) + 1) / (F.coalesce("l", F.lit(0)) + 2)).alias("purity")
    )
    prior = total.first().purity
    hosts = shapes.groupBy("host").agg(F.sum("good").alias("g"), F.sum("labelled").alias("l"))
    hosts = hosts.select("host", _smoothed(F.lit(prior)).alias("purity"))
    open_shapes = shapes.join(hosts, "host").withColumns({"node": F.lit(""), "rest": F.col("shape")})
    done, level = [], 0
    while not (level and open_shapes.isEmpty()):
        level += 1
        passed = steps.keep(_passed(open_shapes), f"passed-{level}")
        branched = steps.keep(_branched(passed), f"branched-{level}")
        done.append(branched.where("ended"))
        open_shapes = branched.where("NOT ended").drop("ended")
    template = F.concat(F.lit("/"), F.substring("node", F.lit(1), F.length("node") - 1))
    return reduce(DataFrame.unionAll, done).select("host", "shape", template.alias("template"), "purity")


def judge(
    pages: DataFrame, rules: tuple[Rule, ...] = RULES, page_id: str = "page_id", url: str = "url"
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) of every row."""
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    text, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", text.alias("rule"), verdict.alias("ruled"), _shape(F.col("path")).alias("shape"))
    shapes = rows.groupBy("host", "shape").agg(
        F.count("*").alias("n"),
        F.count_if(F.col("ruled") == "allow").alias("good"),
        F.count("ruled").alias("labelled"),
    )
    steps = Steps(pages.sparkSession, "url-templates")
    purity = stored(template_purity(steps.keep(shapes, "shapes"), steps), "purity")
    steps.drop()
    by_method = F.when(F.col("purity") < PURITY, "block").otherwise("allow")
    return rows.join(purity, ["host", "shape"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_method).alias("verdict"), "template", "purity"
    )
