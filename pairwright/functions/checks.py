"""Rules that fail a whole input. A rule gives a message for each row that breaks it, null for the others.

`violations` is the audit form, a table; `enforce` runs one action over all rules and raises the first message by row
order. Nothing is ever dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class InputError(ValueError):
    """An input that breaks a rule."""


def violations(rows: DataFrame, rules: dict[str, Column], order: list[str]) -> DataFrame:
    """(order columns, rule, message): one row for each broken rule, rules numbered as given."""
    broken = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(name).alias("rule"), message.cast("string").alias("message")) for i, (name, message) in enumerate(rules.items())])
    some = rows.filter(F.coalesce(*[message.cast("string") for message in rules.values()]).isNotNull())  # rows that break none make no array
    return some.select(*order, F.explode(F.filter(broken, lambda b: b["message"].isNotNull())).alias("b")).select(*order, "b.rank", "b.rule", "b.message")


def enforce(found: DataFrame, order: list[str]) -> None:
    """Raise InputError with the first violation, if there is one."""
    first = found.orderBy(*order, "rank").first()
    if first is not None:
        raise InputError(first["message"])


def unless(good: Column, message: Column | str) -> Column:
    """The message where `good` is false or null."""
    return F.when(~F.coalesce(good, F.lit(False)), F.lit(message) if isinstance(message, str) else message)
