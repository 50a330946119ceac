"""URL filter: rules by host and path, and for other pages a tree of path templates judged by labelled purity.

Per host, the segments of a path form a branch of a tree, down to the last of them. Runs of digits are generalised
first. Then level by level, from the root:

- a position with many values, most of them rare, is variable and becomes ``*``;
- else branches whose share of good labelled pages does not differ from that of their siblings (a two-proportion test)
  are merged into ``*``, and those that differ are merged with those that differ to the same tenth of good pages.

Pages below a node with fewer than ``DIFFERENT`` labels, with good or bad ones alone, or with one path, cannot differ at
any later segment (a squared z is at most the number of labels): they take a ``*`` for each segment left, and no further
level is read for them. Segments that all pages of a node have in common cannot differ either: a chain of them is taken
in one step, so the levels read are those where a path branches.

A template is rejected if its purity, the share of good pages among its labelled ones, smoothed towards the share among
all, is below ``PURITY``. All of this runs on counts by host and digit-free path, which Spark sums before any shuffle;
pages then take the verdict of their path. DataFrame functions only.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airsift.llm.store import stored

# Levels whose ended branches are kept as tables of their own.
LEVELS_APART = 16
# A position is variable from so many values on, if they have fewer than so many pages each on average.
VARIABLE_VALUES, VARIABLE_MEAN = 16, 3
# Squared z from which two branches differ.
DIFFERENT = 9.0
SMOOTHING = 8.0
PURITY = 0.5

# (verdict, host and path): a rule fits its host and all subdomains.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    found = F.coalesce(F.regexp_extract(url, URL, 1), F.lit(""))
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, both null without one; equally long ones in their given order."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule in sorted(rules, key=lambda r: len(r[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + start)
        name, verdict = F.when(fits, rule).otherwise(name), F.when(fits, says).otherwise(verdict)
    return name, verdict


def _template_table(pages: DataFrame) -> DataFrame:
    """host, shape, template and the pages, labelled and good pages of each host's digit-free path."""
    counts = stored(
        pages.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count("good").alias("labelled"), F.sum(F.coalesce(F.col("good").cast("long"), F.lit(0))).alias("n_good")),
        "shapes",
    )
    parts = F.filter(F.split("shape", "/"), lambda part: part != "")
    tree = counts.withColumn("parts", parts).withColumn("template", F.lit(""))
    columns = ["host", "shape", "template", "n", "labelled", "n_good"]
    done: list[DataFrame] = []
    level = 0
    while True:
        tree = _after_common(tree).withColumn("part", F.get("parts", F.lit(0)))
        node = ["host", "template", "part"]
        sums = [F.sum(c).alias(c) for c in ("n", "labelled", "n_good")]
        branches = tree.groupBy(*node).agg(F.count("*").alias("shapes"), *sums)
        whole = branches.groupBy("host", "template").agg(
            F.count("part").alias("values"), *(F.sum(F.when(F.col("part").isNotNull(), F.col(c))).alias(f"all_{c}") for c in ("shapes", "n", "labelled", "n_good"))
        )
        rest, rest_good = F.col("all_labelled") - F.col("labelled"), F.col("all_n_good") - F.col("n_good")
        bad_all = F.col("all_labelled") - F.col("all_n_good")
        gap = (F.col("n_good") * rest - rest_good * F.col("labelled")).cast("double")
        spread = F.col("labelled").cast("double") * rest * F.col("all_n_good") * bad_all
        differs = (spread > 0) & (gap * gap * F.col("all_labelled") >= F.lit(DIFFERENT) * spread)
        variable = (F.col("values") >= VARIABLE_VALUES) & (F.col("all_n") < VARIABLE_MEAN * F.col("values"))
        tenth = F.expr("cast((10 * (n_good + 1)) div (labelled + 2) as string)")
        step = F.when(F.col("part").isNull(), "").when(differs & ~variable, F.concat(F.lit("/~"), tenth)).otherwise("/*")
        separable = (F.col("all_shapes") > 1) & (F.col("all_labelled") >= DIFFERENT) & (F.col("all_n_good") > 0) & (bad_all > 0)
        decided = branches.join(whole, ["host", "template"]).select(
            *node, step.alias("step"), (F.col("part").isNotNull() & separable).alias("open")
        )
        renamed = decided.toDF("_host", "_template", "_part", "step", "open")
        same = (tree["host"] == renamed["_host"]) & (tree["template"] == renamed["_template"]) & tree["part"].eqNullSafe(renamed["_part"])
        steps = F.when(F.col("open") | F.col("part").isNull(), F.col("step")).otherwise(F.expr("repeat('/*', size(parts))"))
        deeper = (
            tree.join(renamed, same)
            .withColumns({"template": F.concat("template", steps), "parts": F.expr("slice(parts, 2, greatest(size(parts) - 1, 0))")})
            .select(*columns, "parts", "open")
        )
        # Each level reads the one above several times: stored, or the plan would grow by a power of the depth.
        tree = stored(deeper, f"level-{level}")
        done.append(tree.where(~F.col("open")).select(*columns))
        tree = tree.where("open").select(*columns, "parts")
        level += 1
        if tree.isEmpty():
            break
        if len(done) == LEVELS_APART:
            done = [stored(_union(done), "ended")]
    return stored(_union(done), "tree")


def _after_common(tree: DataFrame) -> DataFrame:
    """``tree`` after the segments that all paths of a node begin with: those of its least and its greatest path in order."""
    ends = tree.groupBy("host", "template").agg(F.min("parts").alias("lo"), F.max("parts").alias("hi"))
    equal = F.expr("if(size(lo) = 0, 0, aggregate(sequence(1, size(lo)), 0, (k, i) -> if(k = i - 1 and lo[i - 1] = get(hi, i - 1), i, k)))")
    node = ends.select(F.col("host").alias("_host"), F.col("template").alias("_template"), equal.alias("common"))
    joined = tree.join(node, (tree["host"] == node["_host"]) & (tree["template"] == node["_template"]))
    rest = F.expr("slice(parts, common + 1, size(parts) - common)")
    return joined.withColumns({"template": F.expr("concat(template, repeat('/*', common))"), "parts": rest}).drop("_host", "_template", "common")


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.union, tables)


def judge(pages: DataFrame, rules: tuple[tuple[str, str], ...] = RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template and purity of the template.

    ``pages`` has page_id, url and ``good``: true or false for labelled pages, else null. A null url, or one without
    ``://``, has an empty host and path; all of those are one template. Repeated rows and null ids are judged like
    others; an empty table gives no rows. Without labelled pages nothing is rejected.
    """
    url = F.col("url").cast("string")
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("good").cast("boolean").alias("good"))
    shaped = base.withColumn("shape", F.regexp_replace("path", "[0-9]+", "{n}"))
    tree = _template_table(shaped)
    total = tree.agg(F.sum("labelled").alias("labelled"), F.sum("n_good").alias("n_good")).first()
    prior = total["n_good"] / total["labelled"] if total["labelled"] else 1.0
    purity = (F.sum("n_good") + F.lit(SMOOTHING * prior)) / (F.sum("labelled") + F.lit(SMOOTHING))
    judged = tree.groupBy("host", "template").agg(purity.alias("purity"))
    by_shape = tree.select("host", "shape", "template").join(judged, ["host", "template"]).select(F.col("host").alias("_host"), F.col("shape").alias("_shape"), "template", "purity")
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    joined = shaped.join(by_shape, (F.col("host") == F.col("_host")) & (F.col("shape") == F.col("_shape")))
    verdict = F.coalesce(said, F.when(F.col("purity") < PURITY, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "template", "purity")


def label_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id, url and good: a page shows the document whose number its path holds, and is as good as that.

    Of several labels for one document the worst counts; numbers too long for an id have no label.
    """
    number = F.expr("try_cast(regexp_extract(path, '/([0-9]+)', 1) as bigint)")
    numbered = pages.select("page_id", "url").withColumn("path", path_of(F.col("url").cast("string"))).select("page_id", "url", number.alias("number"))
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("labelled")).agg((F.min("quality") == 1).alias("good"))
    return numbered.join(known, numbered["number"] == known["labelled"], "left").select("page_id", "url", "good")


def oracle() -> str:
    """The same in SQL, recursively a level of the tree at a time to the last segment."""
    rules = sorted(RULES, key=lambda r: -len(r[1]))
    fits = []
    for says, rule in rules:
        domain, _, start = rule.partition("/")
        fits.append((f"(base.host = '{domain}' or ends_with(base.host, '.{domain}')) and starts_with(path, '/{start}')", rule, says))
    rule_case = "case " + " ".join(f"when {c} then '{rule}'" for c, rule, _ in fits) + " end"
    said_case = "case " + " ".join(f"when {c} then '{says}'" for c, _, says in fits) + " end"
    return f"""
    with recursive cut as (
        select page_id, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') as host,
               coalesce(regexp_extract(url, '{URL}', 2), '') as path from pages),
    known as (select doc_id, min(quality) = 1 as good from labels where doc_id is not null and quality is not null group by doc_id),
    base as (
        select cut.*, regexp_replace(path, '[0-9]+', '{{n}}', 'g') as shape, good
        from cut left join known on try_cast(nullif(regexp_extract(path, '/([0-9]+)', 1), '') as bigint) = doc_id),
    tree(host, shape, parts, template, n, labelled, n_good, level) as (
        select host, shape, list_filter(string_split(shape, '/'), lambda x: x <> ''), '',
               count(*), count(good), count(*) filter (where good), 0 from base group by host, shape
        union all
        select host, shape, parts, template || case
                   when not (vals >= {VARIABLE_VALUES} and an < {VARIABLE_MEAN} * vals) and l > 0 and al > l and ag > 0 and al > ag
                        and cast(g * (al - l) - (ag - g) * l as double) * cast(g * (al - l) - (ag - g) * l as double) * al
                            >= {DIFFERENT} * (cast(l as double) * (al - l) * ag * (al - ag))
                   then '/~' || cast((10 * (g + 1)) // (l + 2) as varchar) else '/*' end, n, labelled, n_good, level + 1
        from (select *, sum(labelled) over branch as l, sum(n_good) over branch as g, count(distinct part) over node as vals,
                     sum(n) over node as an, sum(labelled) over node as al, sum(n_good) over node as ag
              from (select *, parts[level + 1] as part from tree where level < len(parts))
              window branch as (partition by host, template, part), node as (partition by host, template))),
    ended as (select * from tree where level = len(parts)),
    prior as (select coalesce(cast(sum(n_good) as double) / nullif(sum(labelled), 0), 1.0) as p from ended),
    judged as (
        select host, template, (sum(n_good) + {SMOOTHING} * any_value(p)) / (sum(labelled) + {SMOOTHING}) as purity
        from ended, prior group by host, template)
    select page_id, base.host, path, {rule_case} as rule, coalesce({said_case}, case when purity < {PURITY} then 'block' else 'allow' end) as verdict,
           t.template, cast(purity as double) as purity
    from base join ended t on base.host = t.host and base.shape = t.shape
    join judged j on t.host = j.host and t.template = j.template
    """
