"""URL filter: rules first, then a tree of path templates per host."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aqlake.llm.shared import ascii_lower, store

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
MIN_KINDS = 8  # different segments below a node from which on they may be a variable
MAX_REUSE = 2  # different paths of a segment without a digit that counts as a value of a variable, at most
MIN_PURITY = 0.9


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a url without ``://``."""
    mark = F.instr(url, "://")
    rest = F.when(mark > 0, F.substring(url, mark + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def match_rules(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does. Ties go to the earlier rule."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(reversed(rules), key=lambda r: len(r[1])):
        of_host, _, of_path = text.partition("/")
        fits = ((host == of_host) | host.endswith(f".{of_host}")) & path.startswith(f"/{of_path}")
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _purity(blocked: Column, allowed: Column) -> Column:
    """Smoothed share of blocked pages among labelled ones; a half without labels."""
    return (blocked + F.lit(1.0)) / (blocked + allowed + F.lit(2.0))


def templates(urls: DataFrame) -> DataFrame:
    """Add ``template`` to (host, path, n, blocked, allowed), one row per different host and path.

    Level by level, below each node of a host's tree: the segments are a variable, written
    ``*``, if there are at least ``MIN_KINDS`` of them and at least half of them hold a digit
    or lead to at most ``MAX_REUSE`` different paths. Otherwise a segment whose smoothed
    share of blocked pages is within one standard error of its node's is merged with all
    others like it (also ``*``), and a segment that differs keeps its name. This goes on until all paths have ended. The rest
    of a path that is alone below its node is all ``*``, as it cannot differ from its node. Segments that all
    paths of a node share are passed in one step, so there are as many steps as places where paths part, one below
    the other, however deep the paths are.
    """
    cut = F.split(F.regexp_replace("path", r"^/", ""), "/")
    now = store(urls.select("*", F.lit("").alias("template"), cut.alias("segments"), F.lit(False).alias("ended")))
    ended = [now.where("ended")]
    node = ["host", "template"]
    while not (going := now.where(~F.col("ended"))).isEmpty():
        going = store(_past_shared(going))
        ended.append(going.where("ended"))
        going = going.where(~F.col("ended"))
        left = F.size("segments") - 1
        going = going.withColumn("segment", F.get("segments", F.lit(0)))
        sums = [F.sum(c).alias(c) for c in ("n", "blocked", "allowed")]
        branches = store(going.groupBy(*node, "segment").agg(*sums))
        value = F.col("segment").rlike("[0-9]") | (F.col("n") <= MAX_REUSE)
        nodes = store(
            branches.groupBy(*node).agg(
                F.count("*").alias("kinds"),
                F.count_if(value).alias("values"),
                F.sum("n").alias("paths"),
                _purity(F.sum("blocked"), F.sum("allowed")).alias("p"),
            )
        )
        variable = (F.col("kinds") >= MIN_KINDS) & (F.col("values") * 2 >= F.col("kinds"))
        error = F.sqrt(F.col("p") * (F.lit(1.0) - F.col("p")) / (F.col("blocked") + F.col("allowed") + F.lit(2.0)))
        alike = F.abs(_purity(F.col("blocked"), F.col("allowed")) - F.col("p")) <= error
        decided = store(
            branches.join(nodes, node).select(
                *node,
                "segment",
                F.when(variable | alike, F.lit("*")).otherwise(F.col("segment")).alias("name"),
                (F.col("paths") == 1).alias("alone"),
            )
        )
        rest = F.when(F.col("alone"), F.repeat(F.lit("/*"), left)).otherwise(F.lit(""))
        now = store(
            going.join(decided, [*node, "segment"]).select(
                "host",
                "path",
                "n",
                "blocked",
                "allowed",
                F.concat("template", F.lit("/"), "name", rest).alias("template"),
                F.slice("segments", F.lit(2), left).alias("segments"),
                (F.col("alone") | (left == 0)).alias("ended"),
            )
        )
        ended.append(now.where("ended"))
    return reduce(DataFrame.unionByName, ended).drop("segments", "ended")


def _past_shared(going: DataFrame) -> DataFrame:
    """Write ``*`` for the next segments in which the paths of a node that still go on do not differ.

    Such a segment has its node's own share of blocked pages, so it would be merged into ``*`` by itself, one level
    after the other. Every path is held against the longest of its node: the node's first difference is the
    least one of its paths, and a path that is the start of the longest ends without one.
    """
    node = ["host", "template"]
    longest = store(going.groupBy(*node).agg(F.max(F.struct(F.size("segments").alias("size"), "segments")).alias("long")))
    differs = F.array_position(
        F.zip_with("segments", F.slice("long.segments", F.lit(1), F.size("segments")), lambda a, b: a == b), False
    )
    held = store(going.join(longest.select(*node, "long"), node).select(*going.columns, differs.alias("differs")))
    first = held.where("differs > 0").groupBy(*node).agg(F.min("differs").alias("first"))
    size = F.size("segments")
    shared = F.least(F.coalesce(F.col("first") - 1, size), size).cast("int")
    return held.join(store(first), node, "left").select(
        "host",
        "path",
        "n",
        "blocked",
        "allowed",
        F.concat("template", F.repeat(F.lit("/*"), shared)).alias("template"),
        F.slice("segments", shared + 1, size - shared).alias("segments"),
        (shared == size).alias("ended"),
    )


def judge_urls(pages: DataFrame, rules=RULES, min_purity: float = MIN_PURITY) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, template), one row per row of ``pages``.

    A rule is a host and the start of a path; it fits that host and its subdomains, and
    the longest that fits decides. Pages without a rule get their template's verdict:
    block if the smoothed share of blocked pages among the template's pages with a rule
    reaches ``min_purity``, else allow. Null urls and urls without ``://`` have an empty host
    and path. Each host and path counts once, so that copies change no verdict. Other
    columns are not read; an empty table gives an empty one.
    """
    host, path = split_url(F.col("url"))
    parts = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    judged = store(parts.select("*", rule.alias("rule"), verdict.alias("by_rule")))
    once = lambda holds: holds.cast("long")
    urls = judged.select("host", "path", "by_rule").distinct().select(  # host and path decide the rule
        "host",
        "path",
        once(F.lit(True)).alias("n"),
        once(F.col("by_rule").eqNullSafe("block")).alias("blocked"),
        once(F.col("by_rule").eqNullSafe("allow")).alias("allowed"),
    )
    grown = templates(urls)
    pure = grown.groupBy("host", "template").agg(_purity(F.sum("blocked"), F.sum("allowed")).alias("purity"))
    known = store(
        grown.select("host", "path", "template")
        .join(store(pure), ["host", "template"])
        .select("host", "path", "template", (F.col("purity") >= min_purity).alias("rejected"))
    )
    return judged.join(known, ["host", "path"]).select(
        "page_id",
        "url",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", F.when(F.col("rejected"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "template",
    )


def url_digest(pages: DataFrame) -> DataFrame:
    return judge_urls(pages).select("page_id", "host", "path", "rule", "verdict")
