"""What a run found, as rows: coverage of companies, statuses and masks of sources, with a few examples of what needs a look; and the report made from them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .rollups import mask_signal

CONTACT_FIELDS = ("phones", "emails", "websites", "addresses")
ROW = ("section", "name", "metric", "value")


def unpivoted(rows: DataFrame, section: str, name: Column, values: Mapping[str, Column]) -> DataFrame:
    """One row per value of each row, null values left out."""
    named = F.array(*[F.struct(F.lit(k).alias("metric"), v.cast("bigint").alias("value")) for k, v in values.items()])
    return rows.select(F.lit(section).alias("section"), name.cast("string").alias("name"), F.explode(named).alias("v")).select("section", "name", "v.metric", "v.value").filter("value is not null")


def coverage(companies: DataFrame, flags: Mapping[str, Column]) -> DataFrame:
    """One pass: how many companies meet each of the flags, and how many there are."""
    sums = companies.agg(F.count(F.lit(1)).alias("companies"), *[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in flags.items()])
    return unpivoted(sums, "coverage", F.lit("companies"), {k: F.col(k) for k in ("companies", *flags)})


def value_counts(rows: DataFrame, columns: Sequence[str], unknown: str) -> DataFrame:
    """Counts of the values of each column apart, as grouping sets in one pass; null counts as unknown."""
    filled = rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit(unknown)).alias(c) for c in columns])
    counts = filled.groupingSets([[c] for c in columns], *columns).agg(*[F.grouping(c).alias(f"__g{i}") for i, c in enumerate(columns)], F.count(F.lit(1)).alias("value"))
    pick = lambda of: F.coalesce(*[F.when(F.col(f"__g{i}") == 0, of(c)) for i, c in enumerate(columns)])
    return counts.select(pick(F.lit).alias("section"), pick(F.col).alias("name"), F.lit("n").alias("metric"), "value")


def source_insights(sources: DataFrame, source: str, status: str, masked: str, blocked: Column, total: int | Column) -> DataFrame:
    """Of each source its results by status, and how many companies have masked fields, masked contacts, or were blocked; signal is 2, 1 or 0 for a high, medium or low share of masked contacts.

    masked is an array of the names of masked fields (null: none); rows without a source are left out. Both groupings come from one pass.
    """
    fields = F.coalesce(F.col(masked), F.array().cast("array<string>"))
    contacts = F.size(F.filter(fields, lambda f: f.isin(*CONTACT_FIELDS)))
    rows = sources.select(F.trim(source).alias("name"), F.coalesce(F.col(status), F.lit("unknown")).alias("status"), F.size(fields).alias("m"), contacts.alias("c"), F.coalesce(blocked, F.lit(False)).alias("b")).filter("name is not null and name <> ''")
    sums = rows.groupingSets([["name", "status"], ["name"]], "name", "status").agg(
        F.grouping("status").alias("__all"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("m") > 0).alias("companies_masked"), F.count_if(F.col("c") > 0).alias("companies_contact_masked"),
        F.sum("m").alias("fields_masked"), F.sum("c").alias("contact_fields_masked"), F.count_if("b").alias("companies_blocked"),
    )
    signal = mask_signal(F.col("companies_contact_masked"), F.lit(total) if isinstance(total, int) else total)
    level = F.when(signal == "high", 2).when(signal == "medium", 1).otherwise(0)
    sums = sums.withColumn("signal", level)
    whole = F.col("__all") == 1
    named = {k: F.when(whole, F.col(k)) for k in ("companies_masked", "companies_contact_masked", "fields_masked", "contact_fields_masked", "companies_blocked", "signal")}
    one = F.array(*[F.struct(F.lit("source_masks").alias("section"), F.lit(k).alias("metric"), v.cast("bigint").alias("value")) for k, v in named.items()], F.struct(F.lit("source_status").alias("section"), F.col("status").alias("metric"), F.when(~whole, F.col("n")).alias("value")))
    return sums.select("name", F.explode(one).alias("v")).filter("v.value is not null").select("v.section", "name", "v.metric", "v.value")


def examples(rows: DataFrame, sections: Mapping[str, Column], order: str, text: Column, most: int = 20) -> DataFrame:
    """section, place and text of the first rows of each section, at most most of them by order; each task sends no more than that."""
    tagged = F.array_compact(F.array(*[F.when(F.coalesce(v, F.lit(False)), F.lit(k)) for k, v in sections.items()]))
    found = rows.select(F.explode(tagged).alias("section"), F.col(order).alias("__o"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("section").orderBy("__o", "text"))
    return found.withColumn("place", place).filter(F.col("place") <= most).select("section", "place", "text")


def insight_lines(rows: DataFrame, found: DataFrame, sections: Mapping[str, str]) -> DataFrame:
    """The report: part, place and line, titles of sections first. Both inputs are summaries, as long as there are sources and examples."""
    titles = F.create_map(*[F.lit(x) for kv in sections.items() for x in kv])
    number = F.create_map(*[F.lit(x) for i, k in enumerate(sections) for x in (k, i)])
    values = rows.groupBy("section", "name").agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "metric", F.col("value").cast("string")))), ", ").alias("t"))
    lines = values.select("section", F.concat(F.lit("- `"), "name", F.lit("`: "), "t").alias("line"), "name")
    shown = found.select("section", F.concat(F.lit("- "), "text").alias("line"), F.lpad(F.col("place").cast("string"), 6, "0").alias("name"))
    body = lines.unionByName(shown).filter(F.col("section").isin(*sections))
    heads = body.select("section").distinct().select("section", F.concat(F.lit("## "), titles[F.col("section")]).alias("line"), F.lit("").alias("name"))
    return body.unionByName(heads).select(number[F.col("section")].alias("part"), F.row_number().over(Window.partitionBy("section").orderBy("name", "line")).alias("place"), "line")
