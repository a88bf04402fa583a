"""URL verdicts from host rules and a tree of path templates per host.

The longest rule that fits decides, and its verdicts label the tree. Level by level, the segments that follow
one template of a host are counted. A segment that looks like an identifier, or that is one rare
value among many, becomes ``*``; rare values with labels, where the node's pages are not all labelled alike, become
``*+`` or ``*-``. Of the other branches of the node, those with more blocks than the node's average
merge into one branch ``+`` and those with fewer into ``-``, but for branches whose labelled share differs from the
rest of their side by more than chance. A branch without labels joins the side whose child segments are spread like
its own, if one side is nearer than the other. A finished template is blocked if its purity reaches a threshold: the
labelled share of blocks, shrunk towards that of the host's other templates by the template's pages without label, which
is shrunk towards one half by those of the host. So a template without labels has its host's purity, and a few labels
do not speak for many pages without. All of this is grouping and
joining of narrow rows; a host with any number of pages sends one row per task and branch.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and is allowed unless
the template of the empty host is blocked; repeated rows are judged alike and count each time; an
empty table gives no rows; other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewmill.session import keep


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str


#: Segments that are told apart; what follows is one tail.
LEVELS = 5
#: A node with more different segments than this has a variable one.
FAN = 20
#: A value that at least this share of a node's pages has is a word, not a variable.
COMMON = 0.02
#: Child segments are told apart by so many buckets: identifiers, the path's end, and the others by hash.
SHAPE = 16
#: What a page without label weighs beside a labelled one.
UNKNOWN = 0.25
#: Standard errors from which two shares differ.
APART = 1.96

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z lowered, and path; both empty without ``://``."""
    has = F.coalesce(F.instr(url, "://") > 0, F.lit(False))
    rest = F.when(has, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits; null where none does."""
    text = verdict = None
    for rule in sorted(rules, key=lambda r: -len(r.host + r.path)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        named, judged = F.lit(rule.host + rule.path), F.lit(rule.verdict)
        text = F.when(fits, named) if text is None else text.when(fits, named)
        verdict = F.when(fits, judged) if verdict is None else verdict.when(fits, judged)
    return text, verdict


def _identifier(segment: Column) -> Column:
    """Numbers, dates, long hexadecimal words, and long words that mix letters and digits; with an ending or not."""
    return segment.rlike(r"^[0-9][0-9._,-]*(\.[a-z]{1,5})?$|^[0-9a-fA-F-]{12,}(\.[a-z]{1,5})?$|^(?=.*[0-9].*[0-9].*[0-9])(?=.*[A-Za-z]).{10,}$")


def _side_shape(sign: str, node: Window) -> Column:
    """The child segments of the node's labelled branches of one side; null where there are none."""
    mine = (F.col("labelled") > 0) & (F.col("side") == sign)
    # A node has few words, so their counts fit into one list.
    shapes = F.collect_list(F.when(mine, F.col("shape"))).over(node)
    return F.when(F.size(shapes) > 0, F.aggregate(shapes, F.array_repeat(F.lit(0).cast("long"), SHAPE), lambda a, b: F.zip_with(a, b, lambda x, y: x + y)))


def _distance(mine: str, other: str) -> Column:
    """Half the summed differences of two spreads, and what chance leaves of it; null where the other is empty."""
    return F.expr(
        f"if({other} is null, null, aggregate(zip_with({mine}, {other}, (x, y) -> struct(x, y)), "
        "named_struct('x', 0L, 'y', 0L), (a, c) -> named_struct('x', a.x + c.x, 'y', a.y + c.y), "
        f"t -> aggregate(zip_with({mine}, {other}, (x, y) -> struct(x, y)), named_struct('far', 0D, 'error', 0D), "
        "(a, c) -> named_struct('far', a.far + abs(c.x / t.x - c.y / t.y) / 2, 'error', a.error + "
        f"{APART} * sqrt((c.x + c.y) / (t.x + t.y) * (1 - (c.x + c.y) / (t.x + t.y)) * (1 / t.x + 1 / t.y)) / 2))))"
    )


def templates(paths: DataFrame) -> DataFrame:
    """``paths`` (host, path, n, labelled, blocked) with ``template``.

    One join per level, of the paths with the verdicts on the branches of their node.
    """
    parts = F.split(F.regexp_replace("path", "^/", ""), "/", LEVELS + 1)
    rows = paths.withColumn("parts", parts).withColumn("template", F.lit(""))
    for level in range(LEVELS + 1):
        segment = F.get("parts", F.lit(level))
        # What is left after the last level is one tail.
        rows = rows.withColumn("segment", segment if level < LEVELS else F.when(segment.isNotNull(), F.lit("**")))
        following = F.get("parts", F.lit(level + 1))
        child = (
            F.when(following.isNull(), 1).when((following != "") & _identifier(following), 0).otherwise(2 + F.pmod(F.xxhash64(following), F.lit(SHAPE - 2)))
        )
        rows = rows.withColumn("child", child)
        going = rows.filter("segment is not null")
        ended = rows.filter("segment is null").drop("segment", "child")
        branches = going.groupBy("host", "template", "segment").agg(
            F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"),
            F.array(*(F.coalesce(F.sum(F.when(F.col("child") == i, F.col("n"))), F.lit(0)) for i in range(SHAPE))).alias("shape"),
        )
        nodes = branches.groupBy("host", "template").agg(
            F.count("*").alias("fan"), F.sum("n").alias("all"), F.sum("labelled").alias("node_labelled"), F.sum("blocked").alias("node_blocked"),
        )
        seen = branches.join(nodes, ["host", "template"])
        rare = (F.col("fan") > FAN) & (F.col("n") < COMMON * F.col("all"))
        seen = keep(seen.withColumn("variable", (F.col("segment") != "") & (_identifier(F.col("segment")) | rare)), "branches")
        words = seen.filter("not variable")
        # A node has few words: at most FAN, or 1 / COMMON where it has more values. Those above its share
        # of blocks are compared with each other, and so are those below.
        share, node = F.try_divide("blocked", "labelled"), Window.partitionBy("host", "template")
        words = words.withColumn("side", F.when(share >= F.try_divide(F.sum("blocked").over(node), F.sum("labelled").over(node)), "+").otherwise("-"))
        side = Window.partitionBy("host", "template", "side")
        words = words.withColumns(
            {"all_labelled": F.sum("labelled").over(side), "all_blocked": F.sum("blocked").over(side)}
        )
        rest, rest_blocked = F.col("all_labelled") - F.col("labelled"), F.col("all_blocked") - F.col("blocked")
        pooled = F.try_divide("all_blocked", "all_labelled")
        error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1), "labelled") + F.try_divide(F.lit(1), rest)))
        gap = F.abs(share - F.try_divide(rest_blocked, rest))
        alike = F.when((F.col("labelled") > 0) & (rest > 0), gap <= APART * error).otherwise(F.lit(False))
        words = words.withColumn("alike", alike).withColumns(
            {f"{name}_shape": _side_shape(sign, node) for name, sign in (("more", "+"), ("fewer", "-"))}
        )
        # A branch without labels goes where its children are alike; between two such sides nothing tells.
        near = {sign: _distance("shape", f"{name}_shape") for name, sign in (("more", "+"), ("fewer", "-"))}
        words = words.withColumns({"to_more": near["+"], "to_fewer": near["-"]})
        fits = {sign: F.coalesce(F.col(f"{name}.far") <= F.col(f"{name}.error"), F.lit(False)) for sign, name in (("+", "to_more"), ("-", "to_fewer"))}
        nearer = F.coalesce(F.col("to_more.far") < F.col("to_fewer.far"), F.lit(True))
        level_off = F.coalesce(F.col("to_more.far") == F.col("to_fewer.far"), F.lit(False))
        joins = F.when((F.col("labelled") == 0) & (F.col("segment") != "") & ~level_off, F.when(fits["+"] & nearer, "+").when(fits["-"] & (~nearer | F.col("to_more").isNull()), "-"))
        words = words.withColumn("joins", joins).withColumn("joined", F.collect_set("joins").over(node))
        # A labelled branch that is alone on its side shares the side's name with those that joined it.
        met = (F.col("labelled") > 0) & (rest == 0) & F.array_contains("joined", F.col("side"))
        named = words.select(
            "host", "template", "segment",
            F.when(F.col("joins").isNotNull(), F.col("joins"))
            .when((F.col("alike") | met) & (F.col("segment") != ""), F.col("side")).otherwise(F.col("segment")).alias("branch"),
        )
        # Rare values share a wildcard only with values of like labels: a node's labels must not speak for values without.
        of_node = F.try_divide("node_blocked", "node_labelled")
        mixed = (F.col("node_labelled") < F.col("all")) | ((F.col("node_blocked") > 0) & (F.col("node_blocked") < F.col("node_labelled")))
        sign = F.when(
            ~_identifier(F.col("segment")) & (F.col("labelled") > 0) & mixed, F.when(share >= of_node, "+").otherwise("-")
        ).otherwise("")
        ending = F.regexp_extract("segment", r"\.[a-z]{1,5}$", 0)
        variable = seen.filter("variable").select("host", "template", "segment", F.concat(F.lit("*"), sign, ending).alias("branch"))
        choice = named.unionByName(variable)
        rows = going.join(choice, ["host", "template", "segment"]).withColumn(
            "template", F.concat("template", F.lit("/"), "branch")
        ).drop("segment", "branch", "child").unionByName(ended)
        rows = keep(rows, "templates")
    return rows.drop("parts")


def filter_urls(
    pages: DataFrame, rules: list[Rule], url: str = "url", purity: float = 0.9, smoothing: float = 1.0
) -> DataFrame:
    """``pages`` with a struct ``judged``: host, path, rule, verdict, and the path's template with its purity.

    The purity of a template is (blocked + weight * prior) / (labelled + weight), where the weight is 2 * smoothing and
    ``UNKNOWN`` for each page without label, and the prior is the same share over the host's other templates, with one half
    as its prior and all the host's pages without label. Where fewer paths than pages are labelled, the paths count.
    A column named ``judged`` is replaced.
    """
    host, path = split_url(F.col(url))
    whole = F.struct(*(F.col(f"`{c}`") for c in pages.columns if c != "judged"))
    named = pages.select(whole.alias("row"), host.alias("_host"), path.alias("_path"))
    text, verdict = matching_rule(rules, F.col("_host"), F.col("_path"))
    named = named.withColumn("_rule", text).withColumn("_verdict", verdict)
    paths = named.groupBy(F.col("_host").alias("host"), F.col("_path").alias("path")).agg(
        F.count("*").alias("n"),
        F.count("_verdict").alias("labelled"),
        F.count(F.when(F.col("_verdict") == "block", 1)).alias("blocked"),
    )
    shaped = templates(keep(paths, "paths"))
    labelled_path = F.when(F.col("labelled") > 0, 1).otherwise(0)
    sums = shaped.groupBy("host", "template").agg(
        F.sum("labelled").alias("_l"), F.sum("blocked").alias("_b"), F.sum(F.col("n") - F.col("labelled")).alias("_u"),
        F.sum(labelled_path).alias("_lp"), F.sum(1 - labelled_path).alias("_up"),
    )
    # Pages without label; or, where that is more, as many beside the labelled pages as paths beside the labelled paths.
    sums = keep(sums.withColumn("_u", F.greatest(F.col("_u"), F.coalesce(F.col("_l") * F.try_divide("_up", "_lp"), F.lit(0.0)))), "template sums")
    hosts = sums.groupBy("host").agg(F.sum("_l").alias("_hl"), F.sum("_b").alias("_hb"), F.sum("_u").alias("_hu"))
    others = F.col("_hl") - F.col("_l"), F.col("_hb") - F.col("_b")
    prior = (others[1] + smoothing + UNKNOWN * F.col("_hu") / 2) / (others[0] + 2 * smoothing + UNKNOWN * F.col("_hu"))
    weight = 2 * smoothing + UNKNOWN * F.col("_u")
    shares = sums.join(hosts, "host").select(
        "host", "template", ((F.col("_b") + weight * prior) / (F.col("_l") + weight)).alias("purity")
    )
    judged = shaped.select("host", "path", "template").join(shares, ["host", "template"]).select(
        F.col("host").alias("_h"), F.col("path").alias("_p"), "template", "purity"
    )
    met = named.join(keep(judged, "purity"), (F.col("_host") == F.col("_h")) & (F.col("_path") == F.col("_p")))
    final = F.coalesce("_verdict", F.when(F.col("purity") >= purity, "block").otherwise("allow"))
    return met.select(
        "row.*",
        F.struct(
            F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), final.alias("verdict"),
            "template", "purity",
        ).alias("judged"),
    )
