"""Document structure: furniture, coarse units, heading paths, tables across pages."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def page_furniture(blocks: DataFrame) -> DataFrame:
    """Marks blocks (document_id, page, position, role, text) whose text recurs in its role on two pages or more; page numbers always.

    Text is compared in lower case with runs of blanks as one. The counts come from an aggregate, not from a self-join.
    """
    norm = F.lower(F.trim(F.regexp_replace("text", r"\s+", " ")))
    normal = blocks.withColumn("_norm", norm)
    repeated = normal.where("role in ('header', 'footer')").groupBy("document_id", "role", "_norm").agg(F.countDistinct("page").alias("_pages")).where("_pages >= 2")
    marked = normal.join(repeated, ["document_id", "role", "_norm"], "left")
    return marked.withColumn("is_furniture", F.col("_pages").isNotNull() | (F.col("role") == "page_number")).drop("_norm", "_pages")


def coarse_units(blocks: DataFrame) -> DataFrame:
    """unit_index of each block: the number of headings so far, blocks before the first being the cover, 0."""
    running = W.partitionBy("document_id").orderBy("position").rowsBetween(W.unboundedPreceding, 0)
    return blocks.withColumn("unit_index", F.sum(F.col("is_heading").cast("int")).over(running))


def unit_texts(blocks: DataFrame) -> DataFrame:
    """One row per unit: blocks, first and last position, and its text in order."""
    parts = F.sort_array(F.collect_list(F.struct("position", "text")))
    return coarse_units(blocks).groupBy("document_id", "unit_index").agg(
        F.count("*").alias("blocks"), F.min("position").alias("first_position"), F.max("position").alias("last_position"), F.array_join(F.transform(parts, lambda p: p["text"]), "\n").alias("text")
    )


def fold_headings(headings: pd.DataFrame) -> pd.DataFrame:
    """Parent, level and path of one document's headings in order: what has a rank of at least the new one's is popped.

    A weak heading takes its place under the top of the stack but is no parent itself.
    """
    stack: list[tuple[int, int, str]] = []
    parents, levels, paths = [], [], []
    for position, rank, weak, title in zip(headings["position"], headings["rank"], headings["weak"], headings["title"]):
        while stack and stack[-1][1] >= rank:
            stack.pop()
        parents.append(stack[-1][0] if stack else None)
        levels.append(len(stack) + 1)
        paths.append([t for _, _, t in stack] + [title])
        if not weak:
            stack.append((position, rank, title))
    return headings.assign(parent=pd.array(parents, dtype="Int64"), level=levels, path=paths)


def head_paths(headings: DataFrame) -> DataFrame:
    """Headings (document_id, position, rank, weak, title) with parent position, level and path. A fold: order matters throughout."""

    def fold(document: pd.DataFrame) -> pd.DataFrame:
        return fold_headings(document.sort_values("position"))[["document_id", "position", "parent", "level", "path"]]

    return headings.groupBy("document_id").applyInPandas(fold, "document_id long, position long, parent long, level int, path array<string>")


def logical_tables(blocks: DataFrame) -> DataFrame:
    """table_id of table blocks over pages: a continuation joins the table before it if its page is the same or next, with only furniture between.

    ``blocks`` has document_id, page, position, kind (table or other), continues, is_furniture. A table without such a
    predecessor starts a new one; one that says that it continues but has none is marked unbound.
    """
    kept = blocks.where("not is_furniture")
    before = W.partitionBy("document_id").orderBy("position")
    prior = kept.withColumns({"_kind": F.lag("kind").over(before), "_page": F.lag("page").over(before)})
    bound = (F.col("_kind") == "table") & (F.col("page") - F.col("_page") <= 1)
    tables = prior.where("kind = 'table'").withColumn("_joins", F.col("continues") & F.coalesce(bound, F.lit(False)))
    numbered = tables.withColumn("table_id", F.sum((~F.col("_joins")).cast("int")).over(before.rowsBetween(W.unboundedPreceding, 0)))
    return numbered.withColumn("unbound", F.col("continues") & ~F.col("_joins")).drop("_kind", "_page", "_joins")


def repeated_headers(blocks: DataFrame, tolerance: float = 4.0, least_pages: int = 3, gap: int = 3) -> DataFrame:
    """Texts at a page's top with near equal boxes on at least ``least_pages`` pages, at most ``gap`` pages apart.

    Blocks (document_id, page, text, x0, y0) of one text are put in order of page; a new group starts where the page gap or the
    box differs too much from the block before.
    """
    order = W.partitionBy("document_id", "text").orderBy("page", "y0", "x0")
    near = (F.col("page") - F.lag("page").over(order) <= gap) & (F.abs(F.col("x0") - F.lag("x0").over(order)) <= tolerance) & (F.abs(F.col("y0") - F.lag("y0").over(order)) <= tolerance)
    starts = blocks.withColumn("_starts", (~F.coalesce(near, F.lit(False))).cast("int"))
    grouped = starts.withColumn("_group", F.sum("_starts").over(order.rowsBetween(W.unboundedPreceding, 0)))
    found = grouped.groupBy("document_id", "text", "_group").agg(F.countDistinct("page").alias("pages"), F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    return found.where(F.col("pages") >= least_pages).drop("_group")


def retrieval_targets(payloads: DataFrame) -> DataFrame:
    """Each payload's single retrieval target by registered field; what is not registered has none."""
    target = F.when(F.col("field").isin("table_body", "table_caption", "table_footnote"), "table").when(F.col("field").isin("text", "list_items"), "text").when(F.col("field") == "image_caption", "image")
    return payloads.withColumn("target", target)


def admit_missing_member(ordinals: list[int | None]) -> Iterator[bool]:
    """For a run of heading ordinals, whether an unnumbered member fits: the two before it are n - 2 and n - 1, the next n + 1."""
    for k, value in enumerate(ordinals):
        yield value is None and k >= 2 and ordinals[k - 1] is not None and ordinals[k - 2] == ordinals[k - 1] - 1
