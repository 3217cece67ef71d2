"""Adding costly columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``withColumns`` for costly expressions that later filters look at.

    Spark moves a filter below a projection by repeating its expressions; it does
    not move one below a generator, so here each is evaluated once per row.
    """
    made = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(made)))


Rule = tuple[Column, "Column | str"]


def messages(rules: list[Rule]) -> Column:
    """The messages of the rules whose condition holds, in order.

    Built by concatenation, which is compiled; filtering an array of all messages
    is interpreted, and the rules inside it with it.
    """
    none = F.array().cast("array<string>")
    if not rules:
        return none
    parts = [
        F.when(broken, F.array(F.lit(text) if isinstance(text, str) else text)).otherwise(none)
        for broken, text in rules
    ]
    return F.concat(*parts)
