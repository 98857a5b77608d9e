"""Access decisions for whole tables of requests.

Policies are a short configuration list. They compile to Boolean columns, so a
decision is one projection over the requests: no join, no exchange.
Default deny; a matching forbid beats any permit; a condition that cannot be
evaluated (missing field, value that does not convert) skips its policy.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """Another field of the request, to compare with."""

    path: str


@dataclass(frozen=True)
class When:
    """``op``: gt, ge, lt, le, between (value = (low, high)), eq, ne, outside, missing, present.

    A comparison with a missing field on either side does not hold, ``ne`` included;
    ``missing`` and ``present`` ask for a null by name. Numbers are equal as numbers."""

    path: str
    op: str
    value: object = None


@dataclass(frozen=True)
class Policy:
    name: str
    effect: str
    principal: str | None = None
    action: str | None = None
    resource: str | None = None
    roles: Sequence[str] = ()
    conditions: Sequence[When] = field(default_factory=tuple)
    app: str | None = None
    env: str | None = None


def _at(schema: T.StructType, path: str) -> Column:
    """Nested lookup through structs and maps; a path that does not exist is null."""
    first, *rest = path.split(".")
    if first not in schema.names:
        return F.lit(None)
    value, kind = F.col(first), schema[first].dataType
    for step in rest:
        if isinstance(kind, T.MapType):
            value, kind = value[step], kind.valueType
        elif isinstance(kind, T.StructType) and step in kind.names:
            value, kind = value[step], kind[step].dataType
        else:
            return F.lit(None)
    return value


def _compiled(schema: T.StructType, cond: When) -> Column:
    left = _at(schema, cond.path)

    def right(value):
        return _at(schema, value.path) if isinstance(value, Field) else F.lit(value)

    def number(value: Column) -> Column:
        return value.try_cast("double")

    if cond.op in ("eq", "ne"):
        other = right(cond.value)
        both_numbers = number(left).isNotNull() & number(other).isNotNull()
        equal = F.when(both_numbers, number(left) == number(other)).otherwise(left.cast("string") == other.cast("string"))
        return F.coalesce(equal if cond.op == "eq" else ~equal, F.lit(False))
    if cond.op in ("missing", "present"):
        return left.isNull() if cond.op == "missing" else left.isNotNull()
    if cond.op in ("between", "outside"):
        low, high = (number(right(v)) for v in cond.value)
        inside = (number(left) >= low) & (number(left) <= high)
        return F.coalesce(inside if cond.op == "between" else ~inside, F.lit(False))
    a, b = number(left), number(right(cond.value))
    result = {"gt": a > b, "ge": a >= b, "lt": a < b, "le": a <= b}[cond.op]
    return F.coalesce(result, F.lit(False))


def matches(schema: T.StructType, policy: Policy) -> Column:
    """Whether the policy applies to a request."""
    out = F.lit(True)
    for name in ("principal", "action", "resource", "app", "env"):
        wanted = getattr(policy, name)
        if wanted is not None:
            out = out & F.coalesce(F.col(name) == wanted, F.lit(False))
    if policy.roles:
        held = F.arrays_overlap("roles", F.array(*[F.lit(r) for r in policy.roles]))
        out = out & F.coalesce(held, F.lit(False))
    for cond in policy.conditions:
        out = out & _compiled(schema, cond)
    return out


def evaluate_policies(requests: DataFrame, policies: Sequence[Policy]) -> DataFrame:
    """Add ``decision`` (ALLOW or DENY) and the names of the policies that applied."""
    schema = requests.schema
    hits = [F.when(matches(schema, p), F.struct(F.lit(p.name).alias("name"), F.lit(p.effect).alias("effect"))) for p in policies]
    if not hits:
        return requests.withColumns({"decision": F.lit("DENY"), "applied": F.array().cast("array<string>")})
    out = requests.withColumn("_hits", F.array_compact(F.array(*hits)))
    effects = F.col("_hits")["effect"]
    decision = (
        F.when(F.array_contains(effects, "forbid"), "DENY")
        .when(F.array_contains(effects, "permit"), "ALLOW")
        .otherwise("DENY")
    )
    return out.withColumns({"decision": decision, "applied": F.col("_hits")["name"]}).drop("_hits")
