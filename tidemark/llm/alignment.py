"""Alignment of two tokenizers by divide and conquer at shared cuts.

A text is encoded twice, and every token covers a range of bytes. A byte offset where
tokens of both end is a shared cut. The tokens of a text are divided at a shared cut
near the middle, found by bisecting the one side's ends for those of the other, then
both halves the same way; an interval without a cut is a group of the alignment.
The intervals of many texts are divided together, one level at a time.

Tokens whose ranges overlap are linked. How often a pair of ids is linked in the
whole corpus is counted in the tasks first and then added up. The counts of the most
frequent pairs, a bounded number, go to every task; links of all other pairs meet
their counts in a join.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import table
from tidemark.plans.scratch import materialize

# Fixed value: the pattern that cuts text before a byte-level tokenizer merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

MEMORY = 300_000  # units a worker remembers before it starts its memory anew
CHUNK = 1 << 20  # bytes of text aligned together
NEAR = 32  # places tried around a middle before the rest of the interval is searched at once
PAIRS = 2_000_000  # pairs a task counts before it passes them on
FREQUENT = 1 << 20  # pairs whose counts go to every task

# No token crosses the place between a character that is no white space and one of these.
UNIT = re.compile(r"[ \n\t]+[^ \n\t]*")
OTHER_SPACE = re.compile("[\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


class Tokenizers:
    """Both tokenizers, the bytes of their tokens, and the ids of units met before."""

    def __init__(self, byte_path: str, piece_path: str):
        import sentencepiece
        import tiktoken

        with open(byte_path, encoding="utf-8") as file:
            spec = json.load(file)
        own = {b: chr(b) for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174}
        rest = [b for b in range(256) if b not in own]
        byte_of = {c: b for b, c in own.items()} | {chr(256 + i): b for i, b in enumerate(rest)}
        added = {t["content"] for t in spec["added_tokens"]}
        ranks = {bytes(byte_of[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in added}
        merged = [(m if isinstance(m, str) else " ".join(m)).replace(" ", "") for m in spec["model"]["merges"]]
        ids = [spec["model"]["vocab"][m] for m in merged]
        plain = spec["normalizer"] is None and spec["pre_tokenizer"] | {"trim_offsets": None} == {
            "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": None, "use_regex": True,
        }
        if not plain or ids != sorted(ids):
            raise ValueError(f"{byte_path} is no byte-level tokenizer whose ids follow its merges")
        self._a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for raw, i in ranks.items():
            self.bytes_a[i] = raw

        self._b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self._units = not any(re.search(r"[\n\t]|[^▁]▁", p) for p in pieces)
        if max(len(self.bytes_a), len(self.bytes_b)) > 1 << 16:
            raise ValueError("more than 65,536 ids")
        self.length_a, self.length_b = (np.array([len(x) for x in t], np.int32) for t in (self.bytes_a, self.bytes_b))
        self._known_a: dict[str, bytes] = {}
        self._known_b: dict[str, bytes] = {}
        self._odd: set[str] = set()

    def _ids_b(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts that begin with white space; the tokenizer adds a first space of its own."""
        found = self._b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
        # A lone space has no text left; before a line break the added space is a token of its own.
        return [(ids if len(t) > 1 else [self._b.piece_to_id("▁")]) if t[0] == " " else ids[1:] for t, ids in zip(texts, found)]

    def joined_a(self, ids: bytes) -> bytes:
        return b"".join([self.bytes_a[i] for i in array("H", ids)])

    def joined_b(self, ids: bytes) -> bytes:
        return b"".join([self.bytes_b[i] for i in array("H", ids)])

    def _learn(self, units: list[str]) -> None:
        for unit, ids_b in zip(units, self._ids_b(units)):
            a, b = array("H", self._a.encode_ordinary(unit)).tobytes(), array("H", ids_b).tobytes()
            self._known_a[unit], self._known_b[unit] = a, b
            raw = unit.encode()
            if self.joined_b(b) != raw or self.joined_a(a) != raw:
                self._odd.add(unit)

    def encode(self, text: str) -> list[tuple[bytes, bytes]]:
        """Ids of both, as 16-bit numbers, for chunks of the text that end at a shared cut; none if the bytes do not agree."""
        spaced = " " + text
        if not self._units or OTHER_SPACE.search(text):
            chunks = [(array("H", self._a.encode_ordinary(spaced)).tobytes(), array("H", self._b.encode(text)).tobytes())]
            odd = True
        else:
            units = UNIT.findall(spaced)
            fresh = [u for u in dict.fromkeys(units) if u not in self._known_a]
            if fresh:
                if len(self._known_a) + len(fresh) > MEMORY:
                    self._known_a, self._known_b, self._odd = {}, {}, set()
                    fresh = list(dict.fromkeys(units))
                self._learn(fresh)
            some = CHUNK // 8
            parts = [units[at : at + some] for at in range(0, len(units), some)]
            chunks = [(b"".join([self._known_a[u] for u in p]), b"".join([self._known_b[u] for u in p])) for p in parts]
            odd = bool(self._odd) and not self._odd.isdisjoint(units)
        if odd:
            raw = spaced.encode()
            if b"".join(self.joined_a(a) for a, _ in chunks) != raw or b"".join(self.joined_b(b) for _, b in chunks) != raw:
                return []
        return chunks


_LOADED: dict[tuple[str, str], Tokenizers] = {}


def _tokenizers(byte_path: str, piece_path: str) -> Tokenizers:
    """For the life of a Python worker."""
    paths = (byte_path, piece_path)
    if paths not in _LOADED:
        _LOADED[paths] = Tokenizers(*paths)
    return _LOADED[paths]


def _middle(ends_a, ends_b, a0, a1, b0, b1) -> tuple[np.ndarray, np.ndarray]:
    """For each interval the tokens, one of each side, that end at the shared cut nearest to its middle; -1 without one."""
    middle = (a0 + a1 - 2) // 2
    at_a, at_b = np.full(len(a0), -1, np.int64), np.full(len(a0), -1, np.int64)
    left = np.arange(len(a0))
    for step in range(2 * NEAR):
        i = middle[left] + ((step + 1) // 2 if step % 2 else -(step // 2))
        inside = (i >= a0[left]) & (i < a1[left] - 1)
        k, i = left[inside], i[inside]
        value = ends_a[i]
        j = np.searchsorted(ends_b, value)
        same = ends_b[j] == value
        at_a[k[same]], at_b[k[same]] = i[same], j[same]
        left = left[(at_a[left] < 0) & (step < a1[left] - a0[left])]
        if not len(left):
            return at_a, at_b
    for k in left:
        value = ends_a[a0[k] : a1[k] - 1]
        j = np.searchsorted(ends_b[b0[k] : b1[k]], value)
        same = np.flatnonzero(ends_b[b0[k] + j] == value)
        if len(same):
            i = same[np.abs(a0[k] + same - middle[k]).argmin()]
            at_a[k], at_b[k] = a0[k] + i, b0[k] + j[i]
    return at_a, at_b


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, stops_a: np.ndarray, stops_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last tokens of all groups, of both sides, in order.

    ``ends`` are the byte offsets of many texts, one after the other; ``stops`` count each text's tokens and those before,
    and all texts have tokens."""
    a0, b0 = np.concatenate([[0], stops_a[:-1]]), np.concatenate([[0], stops_b[:-1]])
    a1, b1 = stops_a, stops_b
    cuts_a, cuts_b = [a1 - 1], [b1 - 1]
    while len(a0):
        more = (a1 - a0 > 1) & (b1 - b0 > 1)
        a0, a1, b0, b1 = a0[more], a1[more], b0[more], b1[more]
        i, j = _middle(ends_a, ends_b, a0, a1, b0, b1)
        hit = i >= 0
        i, j = i[hit] + 1, j[hit] + 1
        cuts_a.append(i - 1)
        cuts_b.append(j - 1)
        a0, a1 = np.stack([a0[hit], i], 1).ravel(), np.stack([i, a1[hit]], 1).ravel()
        b0, b1 = np.stack([b0[hit], j], 1).ravel(), np.stack([j, b1[hit]], 1).ravel()
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def linked(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of both sides whose byte ranges overlap, in order of ``a``."""
    first = np.searchsorted(ends_b, np.concatenate([[0], ends_a[:-1]]), "right")
    count = np.searchsorted(ends_b, ends_a) - first + 1
    before = np.cumsum(count) - count
    a = np.repeat(np.arange(len(ends_a)), count)
    return a, np.arange(len(a)) - np.repeat(before - first, count)


_WIDTH = np.array([len(str(i)) for i in range(1 << 16)], np.uint8)
_DIGITS = np.frombuffer("".join(str(i).ljust(6) for i in range(1 << 16)).encode(), np.uint8).reshape(-1, 6)


def group_text(ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The groups as text, each followed by a semicolon, and where the text of each group ends."""
    size_a, size_b = np.diff(cuts_a, prepend=-1), np.diff(cuts_b, prepend=-1)
    place_a = np.arange(len(ids_a)) + np.repeat(cuts_b - size_b + 1, size_a)
    place_b = np.arange(len(ids_b)) + np.repeat(cuts_a + 1, size_b)
    ids = np.empty(len(ids_a) + len(ids_b), np.uint16)
    ids[place_a], ids[place_b] = ids_a, ids_b
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[place_a[cuts_a]], mark[place_b[cuts_b]] = ord("|"), ord(";")
    width = _WIDTH[ids]
    rows = _DIGITS[ids]
    rows[np.arange(len(ids)), width] = mark
    text = rows[np.arange(6, dtype=np.uint8) <= width[:, None]]
    return text, np.cumsum(width + np.int64(1))[place_b[cuts_b]]


def _add_counts(kept: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    codes, at = np.unique(np.concatenate([c for c, _ in kept]), return_inverse=True)
    return [(codes, np.bincount(at, weights=np.concatenate([n for _, n in kept])).astype(np.int64))]


DIGEST = ["n_a", "n_b", "n_groups", "n_links"]


def _aligned(docs: DataFrame, key: str, byte_path: str, piece_path: str) -> DataFrame:
    """Written once: digests of documents (``n_a`` is there), their links (``links``), and counts of pairs (``code``)."""
    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("id", docs.schema[key].dataType)]
        + [T.StructField(c, T.LongType()) for c in DIGEST]
        + [T.StructField("groups_sha256", T.StringType()), T.StructField("links", T.BinaryType())]
        + [T.StructField("code", T.LongType()), T.StructField("n", T.LongType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _tokenizers(byte_path, piece_path)
        form, counted, held = None, [], 0

        def rows(**columns):
            size = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays(
                [pa.nulls(size, f.type) if f.name not in columns else pa.array(columns[f.name], f.type)
                 if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray)) else columns[f.name] for f in form], schema=form,
            )

        def counts():
            codes, n = _add_counts(counted)[0]
            for at in range(0, len(codes), 100_000):
                yield rows(code=codes[at : at + 100_000].astype(np.int64), n=n[at : at + 100_000])

        for batch in batches:
            form = form or pa.schema(
                [("row", pa.int64()), ("id", batch.schema.field("id").type)] + [(c, pa.int64()) for c in DIGEST]
                + [("groups_sha256", pa.string()), ("links", pa.binary()), ("code", pa.int64()), ("n", pa.int64())]
            )
            numbers = batch.column("row").to_numpy()
            digest = np.zeros((len(batch), 4), np.int64)
            hashes = [None] * len(batch)
            waiting, size = [], 0

            def align():
                """Links of the waiting chunks; digests and hashes are filled in."""
                owner = np.array([d for d, _, _ in waiting])
                ids_a, ids_b = (np.frombuffer(b"".join(c), np.uint16) for c in ([a for _, a, _ in waiting], [b for _, _, b in waiting]))
                stops_a, stops_b = (np.cumsum([len(w[s]) // 2 for w in waiting]) for s in (1, 2))
                ends_a, ends_b = np.cumsum(known.length_a[ids_a]), np.cumsum(known.length_b[ids_b])
                cuts_a, cuts_b = shared_cuts(ends_a, ends_b, stops_a, stops_b)
                a, b = linked(ends_a, ends_b)
                codes = ids_a[a].astype(np.uint32) << np.uint32(16) | ids_b[b]
                text, text_ends = group_text(ids_a, ids_b, cuts_a, cuts_b)
                groups, links = np.searchsorted(cuts_a, stops_a), np.searchsorted(a, stops_a)
                text_stops = text_ends[groups - 1]
                for i, column in enumerate((stops_a, stops_b, groups, links)):
                    np.add.at(digest[:, i], owner, np.diff(column, prepend=0))
                whole, cut = text.tobytes(), codes.tobytes()
                out = []
                for n, d in enumerate(owner.tolist()):
                    piece = whole[text_stops[n - 1] if n else 0 : text_stops[n]]
                    if hashes[d] is None:
                        hashes[d] = hashlib.sha256(piece[:-1])
                    else:
                        hashes[d].update(b";" + piece[:-1])
                    out.append(cut[4 * (links[n - 1] if n else 0) : 4 * links[n]])
                counted.append(np.unique(codes, return_counts=True))
                return rows(row=numbers[owner], links=out), len(counted[-1][0])

            for d, text in enumerate(batch.column("text").to_pylist()):
                for a, b in known.encode(text) if text else []:
                    waiting.append((d, a, b))
                    size += len(a) + len(b)
                    if size >= CHUNK:
                        found, more = align()
                        yield found
                        waiting, size, held = [], 0, held + more
                        if held > PAIRS:
                            counted[:] = _add_counts(counted)
                            held = len(counted[0][0])
                            if held > PAIRS // 2:
                                yield from counts()
                                counted, held = [], 0
            if waiting:
                found, more = align()
                yield found
                held += more
            yield rows(
                row=numbers, id=batch.column("id"), groups_sha256=[h.hexdigest() if h else "" for h in hashes],
                **{c: digest[:, i] for i, c in enumerate(DIGEST)},
            )
        if counted:
            yield from counts()

    numbered = docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("id"), "text")
    return materialize(numbered.mapInArrow(run, schema), "aligned")


def _frequent(counts: DataFrame, most: int) -> int:
    """A power of two; at most ``most`` pairs are counted as often."""
    bits = F.length(F.bin("n"))
    total = 0
    for r in sorted(counts.groupBy(bits.alias("bits")).agg(F.count(F.lit(1)).alias("pairs")).collect(), reverse=True):
        total += r["pairs"]
        if total > most:
            return 1 << r["bits"]
    return 0


def align(docs: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", frequent: int = FREQUENT) -> DataFrame:
    """One row per document: ``key``, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum``, ``groups_sha256``.

    A is the byte-level tokenizer and encodes a space and the text; B encodes the text and adds that space itself. Literals of
    special tokens are plain text. Texts that are null or empty, or whose tokens do not give the bytes of space and text
    again, have no tokens: zeros and an empty hash. Rows are told apart by number, so keys may be null or repeat, and repeated
    rows all count. A long text is aligned in chunks that end at shared cuts, unless it holds rarer white space than
    space, tab and line feed. ``frequent`` bounds the pairs whose counts go to every task and changes no result. An
    empty table gives no rows; other columns are not read, whatever their names."""
    rows = _aligned(docs, key, byte_path, piece_path)
    counts = rows.where("code IS NOT NULL").groupBy("code").agg(F.sum("n").alias("n"))
    counts = materialize(counts.withColumn("b", F.col("code").bitwiseAND(0xFFFF)), "pair-counts")
    highest = counts.groupBy("b").agg(F.max("n").alias("most"))
    counts = counts.join(highest, "b").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    counts = materialize(counts, "pairs")

    least = _frequent(counts, frequent)
    table_ = counts.where(F.col("n") >= least).toArrow().sort_by("code")
    codes = table_["code"].to_numpy().astype(np.uint32)
    weights = np.stack([table_["best"].to_numpy().astype(np.int64), table_["n"].to_numpy()], 1).reshape(-1, 2)
    shared = rows.sparkSession.sparkContext.broadcast((codes, weights))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, weights = shared.value
        for batch in batches:
            numbers, links = batch.column("row").to_numpy(), batch.column("links")
            at = 0
            while at < len(links):
                stop, size = at, 0
                while stop < len(links) and size < CHUNK:
                    size += len(links[stop].as_buffer())
                    stop += 1
                some = [links[i].as_py() for i in range(at, stop)]
                code = np.frombuffer(b"".join(some), np.uint32)
                owner = np.repeat(np.arange(len(some)), [len(x) // 4 for x in some])
                place = np.minimum(np.searchsorted(codes, code), max(len(codes) - 1, 0))
                known = codes[place] == code if len(codes) else np.zeros(len(code), bool)
                sums = [
                    np.bincount(owner[known], weights=weights[place[known], c], minlength=len(some)).astype(np.int64) for c in (0, 1)
                ]
                rare = ~known
                own, n = np.unique(owner[rare].astype(np.uint64) << np.uint64(32) | code[rare], return_counts=True)
                row = numbers[at:stop]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([row, row[(own >> np.uint64(32)).astype(np.int64)]])),
                        pa.array(np.concatenate([sums[0], np.zeros(len(own), np.int64)])),
                        pa.array(np.concatenate([sums[1], np.zeros(len(own), np.int64)])),
                        pa.array(np.concatenate([np.full(len(row), -1), (own & np.uint64(0xFFFFFFFF)).astype(np.int64)])),
                        pa.array(np.concatenate([np.zeros(len(row), np.int64), n])),
                    ],
                    ["row", "n_best", "count_sum", "code", "times"],
                )
                at = stop

    weighed = rows.where("links IS NOT NULL").select("row", "links")
    weighed = weighed.mapInArrow(weigh, "row long, n_best long, count_sum long, code long, times long")
    weighed = materialize(weighed, "weighed-links")
    known = weighed.where("code < 0").select("row", "n_best", "count_sum")
    rare = weighed.where("code >= 0").select("row", "code", "times").join(counts.where(F.col("n") < least), "code")
    rare = rare.select("row", (F.col("times") * F.col("best").cast("long")).alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    sums = known.unionByName(rare).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    nothing = F.lit(0).cast("long")
    return rows.where("n_a IS NOT NULL").join(sums, "row", "left").select(
        F.col("id").alias(key), *DIGEST, F.coalesce("n_best", nothing).alias("n_best"),
        F.coalesce("count_sum", nothing).alias("count_sum"), "groups_sha256",
    )


def align_query(spark, folder: str) -> DataFrame:
    import public_tokenizers

    return align(
        table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    )
