"""URL filters by path templates learned per host from labelled pages (10).

A url's path is a way down a tree of segments. Segments that are made of numbers or digests
become wildcards by their form. At every node the children are tested: if their counts look like
those of pages dealt evenly over many values, and their shares of good pages do not differ, what
they hold is a variable, and they become one wildcard. What remains is a template. Templates of
a host that differ in one segment, at any place, are branches of a pool; a pool in which the
shares of good pages differ is parted at its share until those of each part are alike, and the
branches of a part are merged. A template is rejected if the smoothed share of good pages among
its labelled ones is too small.

The tree is built level by level with grouped counts, down to the last segment that two shapes
have in common, so a host with a third of all pages is counted by all tasks and no task holds a
host's templates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.plans.staging import stored

#: Fewer children than this are never taken for values of a variable.
LEAST_CHILDREN = 8
#: Standard deviations beyond which a count or a spread is no chance.
SPREAD_SCORE = 3.0
PRIOR_WEIGHT = 10.0
MIN_PURITY = 0.5

Rule = tuple[str, str]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, ASCII letters lower-cased, and path; both empty without `://` or for null."""
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(host, upper, upper.lower())
    return F.coalesce(lowered, F.lit("")), F.coalesce(path, F.lit(""))


def rule_match(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest fitting rule, and its verdict; nulls if none fits.

    A rule is (verdict, `host/path`); it fits the host and its subdomains.
    """
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule in sorted(rules, key=lambda r: len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.lit(rule)).otherwise(found)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return found, verdict


def _form(segment: Column) -> Column:
    """A segment with its variable parts by form: digits and digests; an extension stays."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z]{1,5})$", 1)
    stem = F.regexp_replace(segment, r"\.[A-Za-z]{1,5}$", "")
    return (
        F.when(stem.rlike(r"^[0-9]+$"), F.concat(F.lit("{n}"), extension))
        .when(
            stem.rlike(r"^[0-9a-fA-F-]{16,}$") & stem.rlike("[0-9]"),
            F.concat(F.lit("{h}"), extension),
        )
        .when(stem.rlike(r"[0-9]{4,}"),
              F.concat(F.regexp_replace(stem, r"[0-9]{4,}", "{n}"), extension))
        .otherwise(segment)
    )


def _segments(path: Column) -> Column:
    """Forms of all segments; a final slash does not count."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _form)


def _variable_children(children: DataFrame) -> DataFrame:
    """(host, template, child) of the children that are values of a variable.

    `children` has (host, template, child, n, labelled, good). Children far more frequent than
    their siblings' mean are sections of their own, and are left out before the test. The rest
    pass if their counts spread no more than chance around their mean, and their shares of good
    pages no more than chance around their common share.
    """
    node = ["host", "template"]
    plain = stored(children.filter(~F.col("child").contains("{")), "url-children")
    rest = plain
    for step in range(2):  # a large section hides a smaller one at first
        means = rest.groupBy(*node).agg(F.avg("n").alias("mean"))
        limit = F.col("mean") + SPREAD_SCORE * F.sqrt("mean")
        rest = stored(
            rest.join(means, node).filter(F.col("n") <= limit).drop("mean"), f"url-rest{step}"
        )
    sums = rest.groupBy(*node).agg(
        F.count(F.lit(1)).alias("kinds"), F.avg("n").alias("mean"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("squares"), F.sum("n").alias("all"),
        F.sum("good").alias("all_good"), F.sum("labelled").alias("all_labelled"),
        F.count_if(F.col("labelled") > 0).alias("judged"),
        F.sum(F.when(F.col("labelled") > 0, F.col("good") * F.col("good") / F.col("labelled")))
        .alias("good_squares"),
    ).filter(F.col("kinds") >= LEAST_CHILDREN)
    spread = (F.col("squares") / F.col("mean") - F.col("all")) / (F.col("kinds") - 1)
    common = F.try_divide(F.col("all_good"), F.col("all_labelled"))
    share_spread = F.when(
        (F.col("judged") > 1) & (common > 0) & (common < 1),
        (F.col("good_squares") - F.col("all_good") * common)
        / (common * (1 - common) * (F.col("judged") - 1)),
    )

    def chance(value: Column, size: Column) -> Column:
        # a sum of squares over its degrees of freedom: mean 1, variance 2 / degrees
        return value <= 1 + SPREAD_SCORE * F.sqrt(F.try_divide(F.lit(2.0), size))

    even = sums.filter(
        chance(spread, F.col("kinds") - 1)
        & F.coalesce(chance(share_spread, F.col("judged") - 1), F.lit(True))
    )
    return rest.join(even.select(*node), node, "left_semi").select(*node, "child")


def templates(urls: DataFrame) -> DataFrame:
    """(host, segments, template) of the shapes in (host, segments, pages, labelled, good).

    Level by level, each node's children are tested, and the next level continues below the
    generalised node. A shape that is alone in its node keeps its further segments, so the
    levels end where the last two shapes part.
    """
    rows = stored(
        urls.groupBy("host", "segments").agg(
            F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"),
            F.sum("good").alias("good"),
        ).withColumn("template", F.lit("")),
        "url-shapes",
    )
    node, done, level = ["host", "template"], [], 0
    while True:
        shared = rows.groupBy(*node).agg((F.count(F.lit(1)) > 1).alias("shared"))
        marked = stored(
            rows.join(shared, node).withColumn(
                "open", F.col("shared") & (F.size("segments") > level)
            ).drop("shared"),
            "url-level",
        )
        left = F.slice("segments", level + 1, F.greatest(F.size("segments"), F.lit(1)))
        done.append(marked.filter("NOT open").select(
            "host", "segments", F.array_join(F.array_insert(left, 1, F.col("template")), "/")
            .alias("template"),
        ))
        rows = marked.filter("open").drop("open")
        if rows.isEmpty():
            break
        rows = rows.withColumn("child", F.col("segments")[level])
        children = rows.groupBy(*node, "child").agg(
            F.sum("pages").alias("n"), F.sum("labelled").alias("labelled"),
            F.sum("good").alias("good"),
        )
        variable = stored(
            _variable_children(children).withColumn("variable", F.lit(True)), "url-variable"
        )
        step = F.when(F.col("variable"), F.lit("*")).otherwise(F.col("child"))
        rows = stored(
            rows.join(variable, [*node, "child"], "left")
            .withColumn("template", F.concat("template", F.lit("/"), step))
            .drop("child", "variable"),
            "url-rows",
        )
        level += 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def merged_branches(counted: DataFrame) -> DataFrame:
    """(host, template, pool_good, pool_labelled): counts by which a template is judged.

    `counted` has (host, template, labelled, good). For each fixed segment of a template, those
    that differ from it there only are a pool. A pool whose members' shares spread about its own
    share by more than chance is parted there, into those over and those under it, until no pool
    is uneven. A template takes the largest pool that it is in, else its own counts.
    """
    known = counted.filter("labelled > 0").select("host", "template", "labelled", "good")
    parts = F.split("template", "/")
    places = known.select("*", F.posexplode(parts).alias("at", "segment")).filter(
        (F.col("segment") != "") & ~F.col("segment").rlike("[{*]")
    )
    shape = F.array_join(
        F.concat(F.slice(parts, F.lit(1), F.col("at")), F.array(F.lit("*")),
                 F.slice(parts, F.col("at") + 2, F.size(parts))), "/"
    )
    held = stored(
        places.select("host", shape.alias("shape"), "at", "template", "labelled", "good"),
        "url-places",
    )
    held = held.withColumn("side", F.lit(""))
    pool = ["host", "shape", "at", "side"]
    while True:
        sums = held.groupBy(*pool).agg(
            F.sum("good").alias("pool_good"), F.sum("labelled").alias("pool_labelled"),
            (F.count(F.lit(1)) - 1).alias("free"),
            F.sum(F.col("good") * F.col("good") / F.col("labelled")).alias("squares"),
        )
        share = F.col("pool_good") / F.col("pool_labelled")
        spread = (F.col("squares") - F.col("pool_good") * share) / (share * (1 - share))
        uneven = F.when(
            (F.col("free") > 0) & (share > 0) & (share < 1),
            spread > F.col("free") + SPREAD_SCORE * F.sqrt(2 * F.col("free")),
        )
        parted = stored(sums.filter(uneven).select(*pool, share.alias("middle")), "url-parted")
        if parted.isEmpty():
            break
        over = F.col("good") / F.col("labelled") >= F.col("middle")
        half = F.when(F.col("middle").isNull(), "").when(over, "h").otherwise("l")
        held = stored(
            held.join(parted, pool, "left").withColumn("side", F.concat("side", half))
            .drop("middle"),
            "url-sides",
        )
    final = sums.select(*pool, "pool_good", "pool_labelled")
    best = (
        held.join(final, pool).groupBy("host", "template")
        .agg(F.max(F.struct("pool_labelled", "pool_good")).alias("best"))
    )
    return known.join(best, ["host", "template"], "left").select(
        "host", "template",
        F.coalesce("best.pool_good", "good").alias("pool_good"),
        F.coalesce("best.pool_labelled", "labelled").alias("pool_labelled"),
    )


def filter_urls(
    pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = (), *,
    id_column: str = "page_id", url_column: str = "url", min_purity: float = MIN_PURITY,
) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity) of every row.

    `labels` has (id, good): one boolean for some of the ids, repeated ones averaged. A rule
    that fits decides; else the template's smoothed share of good labelled pages, which the
    host's pages with few labels draw towards the share of all labelled pages; a share of just
    `min_purity` is allowed. A template without labels is allowed, and so is a null or unusable
    url. Paths of any length and depth are read whole. Repeated rows are judged alike, each by
    itself; an empty table has no rows.
    """
    host, path = host_and_path(F.col(f"`{url_column}`"))
    base = pages.select(F.col(f"`{id_column}`").cast("long").alias("id"), host.alias("host"),
                        path.alias("path"))
    found, decision = rule_match(F.col("host"), F.col("path"), rules)
    rows = base.select("*", found.alias("rule"), decision.alias("decision"),
                       _segments(F.col("path")).alias("segments"))
    marks = labels.filter("id IS NOT NULL").groupBy("id").agg(
        F.avg(F.col("good").cast("int")).alias("good")
    )
    labelled = rows.select("id", "host", "segments").join(
        stored(marks, "url-labels"), "id", "left"
    )
    counted = stored(
        labelled.groupBy("host", "segments").agg(
            F.count(F.lit(1)).alias("pages"), F.count("good").alias("labelled"),
            F.sum(F.coalesce("good", F.lit(0.0))).alias("good"),
        ),
        "url-counts",
    )
    named = stored(templates(counted), "url-templates")
    by_template = counted.join(named, ["host", "segments"]).groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("good").alias("good")
    )
    branches = merged_branches(stored(by_template, "url-branches"))
    prior = counted.agg(
        ((F.sum("good") + 1) / (F.sum("labelled") + 2)).alias("prior")
    ).scalar()
    purity = (F.col("pool_good") + PRIOR_WEIGHT * prior) / (F.col("pool_labelled") + PRIOR_WEIGHT)
    judged = stored(
        named.join(branches, ["host", "template"], "left")
        .select("host", "segments", "template", purity.alias("purity")),
        "url-verdicts",
    )
    return rows.join(judged, ["host", "segments"], "left").select(
        "id", "host", "path", "rule",
        F.coalesce(
            "decision",
            F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow")),
        ).alias("verdict"),
        "template", "purity",
    )
