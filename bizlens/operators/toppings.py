"""Operators on items made of listed parts (recipes, exclusions, extras).

Items repeat few list texts, so texts are made once for each distinct list (or
recipe with its changes) and joined back to the items, those of frequent lists
in many parts (``keys.join_hot``). The parts come from a
table (``topping_id, topping_name``) of any size, met by opened lists in an
equi join; a part that the table lacks has no name and is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.functions.text import csv_items
from bizlens.operators.keys import join_hot, key_counts


def list_names(texts: DataFrame, toppings: DataFrame, col: str, out: str) -> DataFrame:
    """``col`` and the names of its listed parts in their order (``out``), for
    every list of ``texts`` (one row each) that has any."""
    opened = texts.select(col, F.posexplode(csv_items(col)).alias("__pos", "__id"))
    named = opened.join(toppings, F.col("__id") == F.col("topping_id").cast("string"))
    listed = F.sort_array(F.collect_list(F.struct("__pos", "topping_name")))
    return named.groupBy(col).agg(F.array_join(F.transform(listed, lambda x: x["topping_name"]), ", ").alias(out))


def item_label(items: DataFrame, toppings: DataFrame, name: str = "pizza_name", out: str = "order_item") -> DataFrame:
    """Adds 'Name - Exclude A, B - Extra C' from the lists ``exclusions`` and ``extras``."""
    def part(text: str, names: str) -> Column:
        return F.coalesce(F.concat(F.lit(text), F.col(names)), F.lit(""))

    j = items
    for col in ("exclusions", "extras"):
        counts = key_counts(items, [col])
        lists = counts.filter(F.col("__n") > 0)  # reads the count, so that both uses share one exchange
        j = join_hot(j, list_names(lists, toppings, col, f"__{col}"), [col], counts, "left")
    label = F.concat(F.col(name), part(" - Exclude ", "__exclusions"), part(" - Extra ", "__extras"))
    return j.select(*[F.col(c) for c in items.columns if c != out], label.alias(out))


def ingredient_list(items: DataFrame, recipes: DataFrame, toppings: DataFrame, name: str = "pizza_name",
                    out: str = "ingredient_list") -> DataFrame:
    """Adds 'Name: A, 2xB, ...': the recipe's parts without the exclusions
    and with the extras, alphabetical (case-insensitive), with 'Nx' before a part
    that occurs N > 1 times. Items of an unknown recipe are left out."""
    changes = ["__recipe", "exclusions", "extras"]
    j = items.join(recipes.select("pizza_id", F.col("toppings").alias("__recipe")), "pizza_id")
    counts = key_counts(j, changes)
    kinds = counts.filter(F.col("__n") > 0)
    out_of = csv_items("exclusions")
    kept = F.when(F.size("__out") == 0, F.col("__in")).otherwise(F.filter("__in", lambda p: ~F.array_contains("__out", p)))
    opened = kinds.withColumns({"__in": csv_items("__recipe"), "__out": out_of}).select(*changes, F.explode(F.concat(kept, csv_items("extras"))).alias("__id"))
    named = opened.join(toppings, F.col("__id") == F.col("topping_id").cast("string"))
    counted = named.groupBy(*changes, "topping_name").agg(F.count("*").alias("n"))
    text = F.when(F.col("n") > 1, F.concat(F.col("n").cast("string"), F.lit("x"), F.col("topping_name"))).otherwise(F.col("topping_name"))
    listed = F.sort_array(F.collect_list(F.struct(F.lower("topping_name").alias("k"), F.col("topping_name").alias("name"), text.alias("text"))))
    lists = counted.groupBy(*changes).agg(F.array_join(F.transform(listed, lambda x: x["text"]), ", ").alias("__text"))
    j = join_hot(j, lists, changes, counts, "left")
    made = F.concat(F.col(name), F.lit(": "), F.coalesce("__text", F.lit("")))
    return j.select(*[F.col(c) for c in items.columns if c != out], made.alias(out))


def ingredient_usage(items: DataFrame, recipes: DataFrame, toppings: DataFrame, out: str = "total_quantity") -> DataFrame:
    """How often each part is used by the items after exclusions and
    extras; items are counted by (recipe, exclusions, extras) before lists are opened."""
    patterns = items.groupBy("pizza_id", "exclusions", "extras").agg(F.count("*").alias("n"))
    opened = patterns.join(recipes.select("pizza_id", csv_items("toppings").alias("__recipe")), "pizza_id")
    kept = F.array_except(F.col("__recipe"), csv_items("exclusions"))
    used = opened.select(F.explode(F.concat(kept, csv_items("extras"))).alias("t"), "n").groupBy("t").agg(F.sum("n").alias("n"))
    return used.join(toppings, F.col("t") == F.col("topping_id").cast("string")).groupBy("topping_name").agg(F.sum("n").alias(out))
