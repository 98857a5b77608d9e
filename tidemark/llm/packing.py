"""Pack token sequences by the sum-of-squares rule.

Documents are tokenized and cut into pieces of at most ``capacity`` tokens. With
N(g) the number of open sequences that have exactly g tokens free, a piece goes
where the sum of N(g)^2 becomes smallest, which keeps the free spaces varied
and so finds exact fits for later pieces. Pieces are dealt by a hash into groups
of bounded size, packed one group per task call; what a group could not fill
well is dissolved and packed once more in fewer groups.
"""

from __future__ import annotations

import re
import sys
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table
from tidemark.plans.scratch import materialize

# Bytes that a task remembers of words and of their parts before it starts either memory anew.
WORDS, PARTS = 112_000_000, 64_000_000
# Bytes that an entry takes besides what grows with its key, about.
ENTRY = 150
# Texts that are encoded together, and the characters after which no further one is added; bytes of ids given out together.
TEXTS, CHARACTERS, GIVEN = 64, 1 << 20, 8 << 20


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length (1 to ``capacity``), placed in the given order.

    Ties go to the fullest bin, and among equals to the one used last; a new bin is the last choice."""
    free = np.zeros(capacity + 1, np.int64)  # N(g); a bin without free space does not count
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins = np.empty(len(lengths), np.int64)
    offsets = np.empty(len(lengths), np.int64)
    opened = 0
    for i, size in enumerate(lengths.tolist()):
        # Change of the sum if a bin with g free, g = size .. capacity - 1, takes the piece.
        change = np.concatenate([[-1], 2 * free[1 : capacity - size]]) - 2 * free[size:capacity]
        change[free[size:capacity] == 0] = np.iinfo(np.int64).max
        best = int(change.argmin()) if len(change) else 0
        cost = change[best] if len(change) else np.iinfo(np.int64).max
        anew = 2 * free[capacity - size] - 1 if size < capacity else -2
        if cost <= anew and cost != np.iinfo(np.int64).max:
            gap = size + best
            at = stacks[gap].pop()
            free[gap] -= 1
        else:
            gap, at = capacity, opened
            opened += 1
        bins[i], offsets[i] = at, capacity - gap
        left = gap - size
        if left:
            free[left] += 1
            stacks[left].append(at)
    return bins, offsets


def pack_group(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Large pieces first, so that the small ones are left to fill the spaces."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    bins[order], offsets[order] = sum_of_squares(lengths[order], capacity)
    return bins, offsets


def _pieces_pattern(tokenizer):
    """The pattern that cuts lower-cased words, if the tokenizer works that way; else null.

    It has to lower-case, keep the matches of one pattern, and map bytes to characters."""
    import json

    import regex

    spec = json.loads(tokenizer.to_str())
    steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [])
    folds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
    cuts = [p["type"] for p in steps] == ["Split", "ByteLevel"] and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
    ours = folds and cuts and not steps[1]["add_prefix_space"] and sys.byteorder == "little"
    # Added tokens are looked for by their first two signs.
    ours = ours and all(t.content.startswith("<|") for t in tokenizer.get_added_tokens_decoder().values())
    return regex.compile(steps[0]["pattern"]["Regex"]) if ours else None


class Memory:
    """Ids by key, begun anew when they take more than ``most`` bytes."""

    def __init__(self, most: int) -> None:
        self.recent: dict = {}
        self.most = most
        self.long = 0

    def age(self, added: int) -> None:
        """After keys of ``added`` bytes together came in."""
        self.long += added
        if len(self.recent) * ENTRY + 5 * self.long > self.most:
            self.recent, self.long = {}, 0


def _remembered(path: str):
    """The tokenizer, its pattern, and the words and pieces already encoded, for the life of a Python worker."""
    import os
    import sys
    import types

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    holder = sys.modules.setdefault("_tidemark_tokenizers", types.ModuleType("_tidemark_tokenizers"))
    if path not in holder.__dict__:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        holder.__dict__[path] = (tokenizer, _pieces_pattern(tokenizer), Memory(WORDS), Memory(PARTS))
    return holder.__dict__[path]


# Characters that all versions of Unicode class and fold alike; from the first of the two ranges on, bytes are mapped.
PLAIN = re.compile("[\x20-\x7e\xa1-\u0377\u037a-\u037f\u0384-\u052f]+")


def _byte_characters() -> dict[int, str]:
    """The character that stands for each byte in a byte-level vocabulary, by the byte's own code."""
    kept = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return dict(zip([*kept, *(b for b in range(256) if b not in kept)], map(chr, [*kept, *range(256, 512 - len(kept))])))


BYTES = _byte_characters()


def _encode_fresh(fresh: list[bytes], path: str) -> None:
    tokenizer, pattern, memory, memory_of_parts = _remembered(path)
    model, whole, normal = tokenizer.model, [], tokenizer.normalizer
    words, parts = memory.recent, memory_of_parts.recent

    def learn(part: str) -> bytes:
        mapped = part if part.isascii() else part.encode().decode("latin-1").translate(BYTES)
        ids = parts[part] = array("I", [t.id for t in model.tokenize(mapped)]).tobytes()
        return ids

    # The model can be asked for each part where the parts are certain. It does not know added tokens.
    line = b" ".join(fresh).decode()
    plain = fresh if pattern is not None else []
    if "<|" in line or not PLAIN.fullmatch(line):
        plain = [w for w in plain if b"<|" not in w and PLAIN.fullmatch(w.decode())]
        some = set(plain)
        whole = [w for w in fresh if w not in some]
    elif pattern is None:
        whole = fresh
    # The normalizer is asked for the words alone that need it.
    others = [w for w in plain if not w.isascii()]
    plain = [w for w in plain if w.isascii()]
    lowered = b" ".join(plain).decode().lower().split(" ") if plain else []
    lowered += normal.normalize_str(b" ".join(others).decode()).split(" ") if others else []
    for w, text in zip([*plain, *others], lowered, strict=True):
        if text.isalpha():
            words[w] = parts.get(text) or learn(text)
        else:
            words[w] = b"".join([parts.get(p) or learn(p) for p in pattern.findall(text)])
    done = tokenizer.encode_batch_fast([w.decode() for w in whole], add_special_tokens=False)
    words.update((w, array("I", e.ids).tobytes()) for w, e in zip(whole, done))


def _few(texts: Iterable[str | None]) -> Iterator[list[str]]:
    """The texts in order, so few at a time that a text adds little to what is held."""
    few, held = [], 0
    for text in texts:
        few.append(text or "")
        held += len(few[-1])
        if len(few) == TEXTS or held >= CHARACTERS:
            yield few
            few, held = [], 0
    if few:
        yield few


def encode(texts: Iterable[str | None], path: str) -> Iterator[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit numbers.

    The tokenizer never joins characters across white space, so words are encoded one by one and remembered."""
    _, _, words, parts = _remembered(path)
    for few in _few(texts):
        split = [t.encode("utf-8", "replace").split() for t in few]
        fresh = list(set().union(*split).difference(words.recent))
        _encode_fresh(fresh, path)
        known, added = words.recent, sum(map(len, fresh))
        for at, text in enumerate(split):
            split[at] = b"".join(map(known.__getitem__, text))
        words.age(added)
        parts.age(added)
        yield from split


def tokenize(
    docs: DataFrame, path: str, capacity: int = 4096, end: int = 1, key: str = "doc_id", with_ids: bool = False
) -> DataFrame:
    """One row per piece: ``key``, ``piece`` (from 0), ``start``, ``length``, ``ids_crc32`` and, if asked for, ``ids``.

    A document's ids are those of its text, then ``end``. Only documents longer than ``capacity`` are cut.
    Null and empty texts are one piece with the end id alone; a null key is a row like any other. An
    empty table gives no rows. Columns other than ``key`` and ``text`` are not read."""
    fields = [
        docs.schema[key], T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    closing = int(end).to_bytes(4, "little")
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.columns
            rows: list[tuple] = []
            parts: list[bytes] = []
            held = 0

            def given() -> pa.RecordBatch:
                at, *columns = zip(*rows)
                types = pa.int32(), pa.int64(), pa.int64(), pa.int64()
                out = [keys.take(pa.array(at, pa.int64())), *map(pa.array, columns, types)]
                if with_ids:
                    ids = pa.array(np.frombuffer(b"".join(parts), "<u4").astype(np.int32))
                    ends = np.cumsum([0, *columns[2]]).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(ends), ids))
                return pa.RecordBatch.from_arrays(out, names)

            for row, ids in enumerate(encode((t.as_py() for t in texts), path)):
                ids += closing
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((row, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                    if with_ids:
                        parts.append(part)
                        held += len(part)
                        if held >= GIVEN:
                            yield given()
                            rows, parts, held = [], [], 0
            if rows:
                yield given()

    return docs.select(key, "text").mapInArrow(run, T.StructType(fields))


def _pack_round(pieces: DataFrame, capacity: int, group: int, number: int) -> DataFrame:
    """Adds ``_bin`` (within ``_group``), ``offset`` and ``_free`` to ``_row`` and ``length``."""
    groups = max(1, -(-pieces.count() // group))
    schema = "_row long, length long, _group long, _bin long, offset long, _free long, _round int"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_row", ignore_index=True)
        lengths = pdf["length"].to_numpy(np.int64)
        bins, offsets = pack_group(lengths, capacity)
        used = np.bincount(bins, weights=lengths).astype(np.int64)
        return pdf.assign(_bin=bins, offset=offsets, _free=(capacity - used)[bins], _round=number)

    dealt = pieces.select("_row", "length", F.pmod(F.xxhash64("_row"), F.lit(groups)).alias("_group"))
    return dealt.groupBy("_group").applyInPandas(run, schema)


def pack(pieces: DataFrame, capacity: int = 4096, group: int = 8192, loose: int = 64) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.

    Groups of about ``group`` pieces are packed apart. Sequences with more than ``loose`` free tokens are
    opened again and their pieces packed once more, among the loose pieces of all groups. Every piece
    is placed whole; lengths are from 1 to ``capacity``. Columns ``sequence_id`` and ``offset`` are replaced."""
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    # Columns travel under other names, so that none can clash.
    carried = [F.col(c).alias(f"_{i}") for i, c in enumerate(kept)]
    pieces = pieces.select(*carried, F.col("length").alias("length"))
    pieces = materialize(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    first = materialize(_pack_round(pieces, capacity, group, 0), "packed")
    again = _pack_round(first.where(F.col("_free") > loose), capacity, group, 1)
    places = first.where(F.col("_free") <= loose).unionByName(again)
    # Round, group and bin in one number: a group has at most as many bins as pieces.
    sequence = F.col("_group") * 2 + F.col("_round")
    places = places.select("_row", (sequence * F.lit(1 << 32) + F.col("_bin")).alias("sequence_id"), "offset")
    named = [F.col(f"_{i}").alias(c) for i, c in enumerate(kept)]
    return pieces.join(places, "_row").select(*named, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """The token ids of each sequence, at most ``capacity`` of them, from pieces that carry ``ids``."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))


def pack_query(spark, folder: str) -> DataFrame:
    import public_tokenizers

    pieces = tokenize(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pack(pieces)
