"""Keep a computed column computed once.

Long expressions in this package are SQL text: Spark parses the text in one call, where building
the same tree column by column costs hundreds of calls between Python and the JVM.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def stage(df: DataFrame, **columns: str) -> DataFrame:
    """Add ``columns`` (SQL text; replacing same-named ones) behind a narrow, lazy ``inline``.

    The optimizer merges neighbouring projections by copying an expression into each of its uses.
    A chain in which every step uses the last one several times then grows exponentially. Projects
    and filters are not merged through a generator, so each stage is evaluated once per row; there
    is no shuffle and nothing is stored.
    """
    kept = [f"`{c}`" for c in df.columns if c not in columns]
    fields = ", ".join(f"'{name}', {sql}" for name, sql in columns.items())
    return df.selectExpr(*kept, f"inline(array(named_struct({fields})))")
