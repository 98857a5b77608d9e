"""Shape-preserving tokens for SSN, phone and e-mail columns.

Two modes, both native column expressions and both reversible:

* ``obfuscate`` shifts every character by its position. It keeps values out of
  sight but it is not encryption.
* ``keyed`` is a small Feistel permutation whose rounds hash (key, version,
  round, other half). SSN and phone permute their digits; e-mail permutes
  letters and digits and keeps dots, other signs and the top-level domain.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import col_of, is_kind

# Shift and alphabet of the obfuscation mode.
SHIFT = 42
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789.-"

LETTERS = ALPHABET[:62]
SHAPES = {"ssn": "ddd-dd-dddd", "phone": "(ddd) ddd-dddd"}
ROUNDS, TEXT_ROUNDS = 8, 4


def _fill(kind: str, digit) -> Column:
    """The shape of ``kind`` with ``digit(i)`` at its i-th place for a digit."""
    parts, i = [], 0
    for sign in SHAPES[kind]:
        parts.append(digit(i) if sign == "d" else F.lit(sign))
        i += sign == "d"
    return F.concat(*parts)


def _digit(value: Column, kind: str, i: int) -> Column:
    """The i-th digit of a well-shaped value."""
    places = [at for at, sign in enumerate(SHAPES[kind]) if sign == "d"]
    return F.substring(value, places[i] + 1, 1)


def _shift_digits(value: Column, kind: str, sign: int) -> Column:
    def moved(i):
        return F.pmod(_digit(value, kind, i).cast("int") + F.lit(sign * (SHIFT + i)), F.lit(10)).cast("string")

    return _fill(kind, moved)


def _shift_text(text: Column, sign: int) -> Column:
    alphabet = F.lit(ALPHABET)

    def move(char, i):
        at = F.position(char, alphabet)
        to = F.pmod(at - 1 + sign * (i + SHIFT), F.lit(len(ALPHABET)))
        return F.when(at > 0, F.substring(alphabet, to + 1, F.lit(1))).otherwise(char)

    return F.array_join(F.transform(F.split(text, ""), move), "")


def _steps(rounds: int, back: bool) -> Column:
    """Two steps per round: hash the half that stays, then move the other one."""
    order = reversed(range(rounds)) if back else range(rounds)
    return F.array(*[F.lit(n) for r in order for n in (2 * r, 2 * r + 1)])


def _permute_digits(value: Column, kind: str, key: str, version: int, back: bool) -> Column:
    """Feistel rounds add a hash of one half to the other half, modulo 10^n.

    A fold over steps keeps the plan small: each step sees the state of the step
    before as a variable.
    """
    count = SHAPES[kind].count("d")
    sizes = (count // 2, count - count // 2)

    def half(start, size):
        return F.concat(*[_digit(value, kind, start + i) for i in range(size)])

    state = F.struct(half(0, sizes[0]).alias("a"), half(sizes[0], sizes[1]).alias("b"), F.lit(0).cast("long").alias("hash"))

    def moved(part: Column, add: Column, size: int) -> Column:
        to = F.pmod(part.cast("long") + (-add if back else add), F.lit(10**size))
        return F.lpad(to.cast("string"), size, "0")

    def step(acc, n):
        hashing, number, left = _read_step(n)
        still = F.when(left, acc["b"]).otherwise(acc["a"])
        digest = F.sha2(_seed(key, version, number, still), 256)
        number_of = F.conv(F.substring(digest, 1, 14), 16, 10).cast("long")
        return F.struct(
            F.when(~hashing & left, moved(acc["a"], acc["hash"], sizes[0])).otherwise(acc["a"]).alias("a"),
            F.when(~hashing & ~left, moved(acc["b"], acc["hash"], sizes[1])).otherwise(acc["b"]).alias("b"),
            F.when(hashing, number_of).otherwise(acc["hash"]).alias("hash"),
        )

    def shaped(acc):
        def digit(i):
            return F.substring(acc["a"], i + 1, 1) if i < sizes[0] else F.substring(acc["b"], i - sizes[0] + 1, 1)

        return _fill(kind, digit)

    return F.reduce(_steps(ROUNDS, back), state, step, shaped)


def _read_step(n: Column) -> tuple[Column, Column, Column]:
    """(hashing step?, round number, does this round move the left half?)"""
    number = F.floor(n / 2).cast("int")
    return n % 2 == 0, number, number % 2 == 0


def _seed(key: str, version: int, number: Column, still: Column) -> Column:
    return F.concat(F.lit(f"{key}|{version}|"), number.cast("string"), F.lit("|"), still)


def _permute_text(text: Column, key: str, version: int, back: bool) -> Column:
    """The same on letters and digits, each moved by a byte of the other half's hash."""
    middle = F.floor(F.length(text) / 2).cast("int")
    state = F.struct(
        F.substring(text, F.lit(1), middle).alias("a"),
        F.substring(text, middle + 1, F.length(text)).alias("b"),
        F.lit("").alias("hash"),
    )
    letters, size = F.lit(LETTERS), F.lit(len(LETTERS))

    def moved(half: Column, digest: Column) -> Column:
        def move(char, i):
            at = F.position(char, letters)
            add = F.conv(F.substring(digest, 2 * F.pmod(i, F.lit(32)) + 1, F.lit(2)), 16, 10).cast("int") + i
            to = F.pmod(at - 1 + (-add if back else add), size)
            return F.when(at > 0, F.substring(letters, to + 1, F.lit(1))).otherwise(char)

        return F.array_join(F.transform(F.split(half, ""), move), "")

    def step(acc, n):
        hashing, number, left = _read_step(n)
        still = F.when(left, acc["b"]).otherwise(acc["a"])
        seed = _seed(key, version, number, still)
        return F.struct(
            F.when(~hashing & left, moved(acc["a"], acc["hash"])).otherwise(acc["a"]).alias("a"),
            F.when(~hashing & ~left, moved(acc["b"], acc["hash"])).otherwise(acc["b"]).alias("b"),
            F.when(hashing, F.sha2(seed, 256)).otherwise(acc["hash"]).alias("hash"),
        )

    return F.reduce(_steps(TEXT_ROUNDS, back), state, step, lambda acc: F.concat(acc["a"], acc["b"]))


def _email(value: Column, change, keep_top: bool) -> Column:
    name = F.substring_index(value, "@", 1)
    domain = F.substring_index(value, "@", -1)
    if not keep_top:
        return F.concat(change(name), F.lit("@"), change(domain))
    top = F.substring_index(domain, ".", -1)
    labels = F.left(domain, F.length(domain) - F.length(top) - 1)
    return F.concat(change(name), F.lit("@"), change(labels), F.lit("."), top)


def token(value, kind: str, key: str | None = None, version: int = 1, back: bool = False) -> Column:
    """Token of a value of ``kind`` (or, with ``back``, the value of a token).

    Without a key this is the obfuscation. Null stays null; a value without the
    shape gives null. An obfuscated e-mail need not look like one, so its way back
    only asks for the ``@``.
    """
    value = col_of(value)
    if kind == "email":
        if key is None:
            out = _email(value, lambda t: _shift_text(t, -1 if back else 1), False)
        else:
            out = _email(value, lambda t: _permute_text(t, key, version, back), True)
        usable = value.contains("@") if back else is_kind(value, kind)
    else:
        if key is None:
            out = _shift_digits(value, kind, -1 if back else 1)
        else:
            out = _permute_digits(value, kind, key, version, back)
        usable = is_kind(value, kind)
    return F.when(usable, out)


def tokenize_columns(
    df: DataFrame, spec: Mapping[str, str], key: str | None = None, version: int = 1
) -> DataFrame:
    """Replace columns by tokens; ``spec`` maps a column to ``ssn``, ``phone`` or ``email``.

    A row with a malformed value is marked in ``reject_reasons`` and all its tokens
    are null, so that no clear value passes through.
    """
    reasons = F.array_compact(
        F.array(*[F.when(~is_kind(c, kind), F.lit(f"{c}:not_{kind}")) for c, kind in spec.items()])
    )
    out = df.withColumn("reject_reasons", reasons)
    good = F.size("reject_reasons") == 0
    tokens = {c: F.when(good, token(c, kind, key, version)) for c, kind in spec.items()}
    return out.withColumns({**tokens, "key_version": F.lit(version if key else 0)})


def detokenize_columns(df, spec: Mapping[str, str], key: str | None = None, version: int = 1) -> DataFrame:
    return df.withColumns({c: token(c, kind, key, version, back=True) for c, kind in spec.items()})


def token_audit(tokenized: DataFrame, spec: Mapping[str, str], id_col: str, action: str = "ENCRYPT"):
    """One audit row per handled value, one error row per rejected record."""
    done = [
        F.when(F.col(c).isNotNull(), F.struct(F.lit("INFO").alias("level"), F.lit(f"{kind.upper()}_{action}").alias("operation")))
        for c, kind in spec.items()
    ]
    failed = F.when(
        F.size("reject_reasons") > 0,
        F.struct(F.lit("ERROR").alias("level"), F.lit(f"{action}_ERROR").alias("operation")),
    )
    entries = F.array_compact(F.array(*done, failed))
    return tokenized.select(id_col, F.explode(entries).alias("_entry")).select(id_col, "_entry.*")
