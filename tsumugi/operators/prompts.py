"""Prompts as string expressions: style instructions, examples, messages, requests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tsumugi.config import Config
from tsumugi.functions.text import strip
from tsumugi.operators.allocate import batches

SYSTEM = (
    "You write short Japanese texts for a labelled corpus. Each text reports one concrete event in the given category. "
    "Name an invented company or person, state what happened and what it puts at risk, and stay within the category. "
    "Give no dates, links or postal addresses, and do not reuse wording from the examples. Answer with a JSON array and nothing else."
)
NO_TITLE = "(no title)"
FORMAT = 'Answer format: [{"title": "...", "body": "...", "category": "...", "style": "..."}]'


def instruction(styles: DataFrame) -> DataFrame:
    """``style, instruction`` of each preset; the title line only where there is a title range."""
    title = F.when(F.col("title_min").isNotNull() & F.col("title_max").isNotNull(), F.concat(F.lit("\nTitle: "), F.col("title_min").cast("int").cast("string"), F.lit("-"), F.col("title_max").cast("int").cast("string"), F.lit(" characters")))
    body = F.concat(F.lit("\nBody: "), F.col("body_min").cast("int").cast("string"), F.lit("-"), F.col("body_max").cast("int").cast("string"), F.lit(" characters"))
    text = F.concat(F.lit("Style: "), F.col("name"), F.lit("\n"), F.coalesce("description", F.lit("")), F.lit("\nTone: "), F.coalesce("tone", F.lit("")), F.coalesce(title, F.lit("")), F.coalesce(body, F.lit("")))
    return styles.select(F.col("name").alias("style"), "pos", text.alias("instruction"))


def with_instruction(rows: DataFrame, styles: DataFrame) -> DataFrame:
    """``rows`` with the ``instruction`` of their style; an unknown style has that of the first preset."""
    made = instruction(styles)
    first = made.agg(F.min_by("instruction", "pos")).first()[0]
    return rows.join(made.select("style", "instruction"), "style", "left").withColumn("instruction", F.coalesce("instruction", F.lit(first)))


def with_definition(rows: DataFrame, definitions: DataFrame) -> DataFrame:
    """``rows`` with the ``definition`` of their category, of several the least, empty where there is none."""
    one = definitions.groupBy("category").agg(F.min("definition").alias("definition"))
    return rows.join(one, "category", "left").withColumn("definition", F.coalesce("definition", F.lit("")))


def examples(shown: DataFrame, chars: int = 200) -> DataFrame:
    """``category, examples, seed_ids``: each category's chosen rows (``row_id, rep_rank, title, body``) in their order."""
    title = F.coalesce(F.nullif(strip(F.coalesce("title", F.lit(""))), F.lit("")), F.lit(NO_TITLE))
    body = F.substring(strip(F.coalesce("body", F.lit(""))), 1, chars)
    item = F.struct("rep_rank", "row_id", title.alias("title"), body.alias("body"))
    lists = shown.groupBy("category").agg(F.array_sort(F.collect_list(item)).alias("examples"))  # a category's representatives are few
    return lists.withColumn("seed_ids", F.transform("examples", lambda e: e["row_id"].cast("string")))


def with_examples(rows: DataFrame, lists: DataFrame) -> DataFrame:
    """``rows`` with their category's ``examples`` and ``seed_ids``, empty where there are none."""
    empty = {f.name: F.array().cast(f.dataType) for f in lists.schema.fields if f.name != "category"}
    return rows.join(lists, "category", "left").withColumns({n: F.coalesce(n, e) for n, e in empty.items()})


def user_prompt(category: Column, style: Column, definition: Column, instruction_: Column, examples_: Column, per_request: int = 3, shown: int = 3) -> Column:
    """Definition, instruction, at most ``shown`` examples, and the answer's format."""
    listed = F.transform(F.slice(examples_, 1, shown), lambda e, i: F.concat(F.lit("\nExample "), (i + 1).cast("string"), F.lit("\nTitle: "), e["title"], F.lit("\nBody: "), e["body"]))
    wanted = F.concat(F.lit(f"Write {per_request} texts.\nCategory: "), category)
    return F.concat_ws("\n", wanted, F.when(definition != "", F.concat(F.lit("Definition: "), definition)), instruction_, F.concat(F.lit("Requested style: "), style), F.when(F.size(listed) > 0, F.concat(F.lit("Examples:"), F.array_join(listed, ""))), F.lit(FORMAT))


def messages(user: Column) -> Column:
    role = lambda r, c: F.struct(F.lit(r).alias("role"), c.alias("content"))
    return F.array(role("system", F.lit(SYSTEM)), role("user", user))


def requests(matrix: DataFrame, definitions: DataFrame, styles: DataFrame, lists: DataFrame, config: Config = Config(), round_: int = 0) -> DataFrame:
    """A row for each request, with its messages and the ids of all examples (``seed_ids``) and of those shown."""
    prompt = user_prompt(F.col("category"), F.col("style"), F.col("definition"), F.col("instruction"), F.col("examples"), config.per_request, config.examples_shown)
    # one prompt a category and style, repeated for its batches afterwards
    built = with_examples(with_instruction(with_definition(matrix, definitions), styles), lists).withColumn("messages", messages(prompt))
    spread = batches(built, config.per_request)
    return spread.select("category", "style", "style_pos", F.lit(round_).alias("round"), "batch_idx", "messages", "seed_ids", F.slice("seed_ids", 1, config.examples_shown).alias("shown_seed_ids"))


def in_processing_order(matrix: DataFrame) -> DataFrame:
    """``matrix`` with ``position``: categories by their need, most first, styles in their order; for few rows, as a plan has."""
    return matrix.withColumn("total", F.sum("needed").over(Window.partitionBy("category"))).withColumn("position", F.row_number().over(Window.orderBy(F.desc("total"), "category", "style_pos"))).drop("total")
