"""Arrow batches that keep some columns and add others."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Texts in one call of a scoring function, and their characters together.
TEXTS = 2048
CHARACTERS = 16_000_000


def groups(texts: list[str | None], most: int = TEXTS, characters: int = CHARACTERS) -> Iterator[list[str | None]]:
    """The texts in bounded groups; a longer text is a group of its own."""
    group: list[str | None] = []
    size = 0
    for text in texts:
        if group and size + len(text or "") > characters:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text or "")
        if len(group) == most:
            yield group
            group, size = [], 0
    if group:
        yield group


def no_clash(df: DataFrame, made: list[str]) -> None:
    """A column that is to be added must not be there already."""
    if clash := set(df.columns) & set(made):
        raise ValueError(f"columns {sorted(clash)} are there already")


def with_columns_of_texts(
    df: DataFrame, text_col: str, keep: list[str], made: dict[str, tuple[str, pa.DataType]],
    start: Callable[[], Callable[[list[str | None]], dict[str, list]]],
) -> DataFrame:
    """The columns ``keep`` and what a function makes of the texts.

    ``start`` is called once in a task and gives the function from a group of texts to new columns.
    """
    if clash := set(keep) & set(made):
        raise ValueError(f"columns {sorted(clash)} are there already")
    fields = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    schema = ", ".join([f"`{c}` {fields[c]}" for c in keep] + [f"{c} {kind}" for c, (kind, _) in made.items()])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = start()
        for batch in batches:
            row = 0
            for group in groups(batch.column(len(keep)).to_pylist()):
                out = function(group)
                columns = [batch.column(k).slice(row, len(group)) for k in range(len(keep))]
                columns += [pa.array(out[c], kind) for c, (_, kind) in made.items()]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])
                row += len(group)

    chosen = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").alias("\0text"))
    return chosen.mapInArrow(work, schema)
