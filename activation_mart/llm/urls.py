"""URL filter: rules first, then a tree of path templates per host judged by labelled purity."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import settle
from .registry import query, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"://([^/?#]*)([^?#]*)"
MANY_CHILDREN = 10  # a node with so many, and half as many as pages, is variable
CONFIDENCE = 0.05  # of the bound within which two branches count as alike
SMOOTHING = 2.0  # labelled pages that the prior weighs as
MIN_PURITY = 0.4  # share of allowed pages below which a template is rejected


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://`` or for NULL."""
    host = F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Text and verdict of the longest rule that fits, else NULL. A rule fits its host and all subdomains."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _sums(*extra: Column) -> list[Column]:
    return [F.sum(c).alias(c) for c in ("n_pages", "n_labelled", "n_allowed")] + list(extra)


def path_templates(shapes: DataFrame) -> DataFrame:
    """Template and counts of each shape (host, shape, n_pages, n_labelled, n_allowed).

    Below a node of a host's tree, segments become ``*`` where there are many
    children, half as many as pages or more. Other segments are merged into
    ``~`` where their share of allowed pages lies within Hoeffding's bound of
    that of their siblings together, or where either has no labels; what
    differs keeps its name.
    """
    parts = shapes.select(
        "host", "shape", "n_pages", "n_labelled", "n_allowed",
        F.posexplode(F.split("shape", "/")).alias("level", "segment"),
    )
    steps = F.split("shape", "/")
    parts = parts.withColumn("prefix", F.array_join(F.slice(steps, F.lit(1), F.col("level")), "/"))
    node = ["host", "level", "prefix"]
    child = parts.groupBy(*node, "segment").agg(*_sums())
    parent = child.groupBy(*node).agg(
        F.count(F.lit(1)).alias("children"), F.sum("n_pages").alias("all_pages"),
        F.sum("n_labelled").alias("all_labelled"), F.sum("n_allowed").alias("all_allowed"),
    )
    rest = F.col("all_labelled") - F.col("n_labelled")
    far = F.abs(
        F.col("n_allowed") / F.col("n_labelled") - (F.col("all_allowed") - F.col("n_allowed")) / rest
    ) > F.sqrt(F.lit(0.5) * F.log(F.lit(2 / CONFIDENCE))) * (1 / F.sqrt("n_labelled") + 1 / F.sqrt(rest))
    variable = (F.col("children") >= MANY_CHILDREN) & (2 * F.col("children") >= F.col("all_pages"))
    step = (
        F.when(variable, "*")
        .when((F.col("n_labelled") == 0) | (rest == 0), "~")
        .when(far, F.col("segment"))
        .otherwise("~")
    )
    named = child.join(parent, node).select(*node, "segment", step.alias("step"))
    ordered = F.array_sort(F.collect_list(F.struct("level", "step")))
    templates = (
        parts.join(named, [*node, "segment"])
        .groupBy("host", "shape")
        .agg(F.array_join(F.transform(ordered, lambda x: x["step"]), "/").alias("template"))
    )
    return shapes.join(templates, ["host", "shape"])


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Verdict of every page's URL: that of the longest rule, else that of its path template.

    Digits of a path become ``#``, which leaves few shapes per host; they are
    counted before anything is shuffled by host. Pages under a rule are the
    labelled ones. A template's purity is the share of allowed pages among its
    labelled ones, smoothed towards its host's, and that towards the whole
    table's (0.5 without labels); below MIN_PURITY its pages are blocked.

    A NULL URL, or one without ``://``, has an empty host and path, which form
    one template like others; repeated rows are judged alike; an empty table
    gives an empty result; other columns are neither read nor returned.
    """
    host, path = host_and_path(F.col("url"))
    judged = pages.select("page_id", host.alias("host"), path.alias("path"))
    judged = judged.select(
        "*",
        longest_rule(F.col("host"), F.col("path"), rules).alias("found"),
        F.regexp_replace("path", "[0-9]+", "#").alias("shape"),
    )
    judged = settle(judged, "urls")
    shapes = judged.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n_pages"),
        F.count("found.verdict").alias("n_labelled"),
        F.count_if(F.col("found.verdict") == "allow").alias("n_allowed"),
    )
    shapes = path_templates(settle(shapes, "shapes"))
    smooth = lambda good, all_, prior: (good + SMOOTHING * prior) / (all_ + SMOOTHING)
    total = shapes.agg(F.sum("n_allowed"), F.sum("n_labelled")).first()
    base = total[0] / total[1] if total[1] else 0.5
    hosts = shapes.groupBy("host").agg(
        smooth(F.sum("n_allowed"), F.sum("n_labelled"), F.lit(base)).alias("prior")
    )
    templates = shapes.groupBy("host", "template").agg(*_sums()).join(hosts, "host")
    purity = smooth(F.col("n_allowed"), F.col("n_labelled"), F.col("prior"))
    templates = templates.select(
        "host", "template", "n_pages", "n_labelled", "n_allowed",
        F.when(purity < MIN_PURITY, "block").otherwise("allow").alias("by_template"),
    )
    by_shape = shapes.select("host", "shape", "template").join(templates, ["host", "template"])
    return judged.join(by_shape, ["host", "shape"]).select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", "by_template").alias("verdict"),
        "template", F.col("n_pages").alias("template_pages"),
        F.col("n_labelled").alias("template_labelled"), F.col("n_allowed").alias("template_allowed"),
    )


def _sql(rules: Sequence[Rule]) -> str:
    cases = {
        column: " ".join(
            f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
            f" THEN '{getattr(r, column)}'"
            for r in sorted(rules, key=lambda r: -len(r.text))
        )
        for column in ("text", "verdict")
    }
    return f"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '{PARTS}', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '{PARTS}', 2), '') AS path FROM pages),
judged AS (
  SELECT *, CASE {cases['text']} END AS rule, CASE {cases['verdict']} END AS found,
         regexp_replace(path, '[0-9]+', '#', 'g') AS shape FROM parts),
shapes AS (
  SELECT host, shape, count(*) AS n, count(found) AS lab, count(*) FILTER (found = 'allow') AS good
  FROM judged GROUP BY host, shape),
steps AS (
  SELECT host, shape, n, lab, good, string_split(shape, '/') AS s,
         unnest(range(1, len(string_split(shape, '/')) + 1)) AS level FROM shapes),
nodes AS (
  SELECT host, shape, n, lab, good, level, s[level] AS segment, s[:level - 1] AS prefix FROM steps),
child AS (
  SELECT host, level, prefix, segment, sum(n) AS n, sum(lab) AS lab, sum(good) AS good
  FROM nodes GROUP BY ALL),
parent AS (
  SELECT host, level, prefix, count(*) AS children, sum(n) AS pages, sum(lab) AS all_lab, sum(good) AS all_good
  FROM child GROUP BY ALL),
named AS (
  SELECT c.*, CASE
    WHEN children >= {MANY_CHILDREN} AND 2 * children >= pages THEN '*'
    WHEN lab = 0 OR all_lab = lab THEN '~'
    WHEN abs(good::DOUBLE / lab - (all_good - good)::DOUBLE / (all_lab - lab))
         > sqrt(0.5 * ln({2 / CONFIDENCE})) * (1 / sqrt(lab) + 1 / sqrt(all_lab - lab)) THEN segment
    ELSE '~' END AS step
  FROM child c JOIN parent p USING (host, level, prefix)),
templates AS (
  SELECT x.host, x.shape, any_value(x.n) AS n, any_value(x.lab) AS lab, any_value(x.good) AS good,
         string_agg(step, '/' ORDER BY x.level) AS template
  FROM nodes x JOIN named m USING (host, level, prefix, segment) GROUP BY x.host, x.shape),
whole AS (SELECT coalesce(sum(good)::DOUBLE / nullif(sum(lab), 0), 0.5) AS base FROM templates),
hosts AS (
  SELECT host, (sum(good) + {SMOOTHING} * any_value(base)) / (sum(lab) + {SMOOTHING}) AS prior
  FROM templates, whole GROUP BY host),
verdicts AS (
  SELECT host, template, sum(n) AS n, sum(lab) AS lab, sum(good) AS good,
         CASE WHEN (sum(good) + {SMOOTHING} * any_value(prior)) / (sum(lab) + {SMOOTHING}) < {MIN_PURITY}
              THEN 'block' ELSE 'allow' END AS by_template
  FROM templates JOIN hosts USING (host) GROUP BY host, template)
SELECT page_id, host, path, rule, coalesce(found, by_template) AS verdict, template,
       v.n::BIGINT AS template_pages, v.lab::BIGINT AS template_labelled, v.good::BIGINT AS template_allowed
FROM judged JOIN templates t USING (host, shape) JOIN verdicts v USING (host, template)
"""


@query("op2_url_templates", _sql(RULES))
def op2_url_templates(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))
