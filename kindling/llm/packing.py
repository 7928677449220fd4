"""Best-fit packing of token sequences by minimum bin slack."""

from __future__ import annotations

import os
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindling.llm.common import BY_SPACE, _blocks, mix, per_batch, table, written
from kindling.llm.token_counts import byte_characters

TOKENIZER, CAPACITY, END = "word_bpe_49k.json", 2048, 0
#: Places of one length are numbered in this many groups side by side.
GROUPS = 64
#: Encoded chunks that a worker remembers; their memory is bounded, what they encode to is not changed.
REMEMBERED, REMEMBERED_LENGTH = 400_000, 64
#: Bytes of texts whose chunks are looked up together, and the new ones encoded together.
LEARNED = 1 << 20
_LETTER = np.array([b < 128 and chr(b).isalnum() for b in range(256)])
_PUNCTUATION = np.array([33 <= b < 127 and not bytes([b]).isalnum() for b in range(256)])
WORD_END = "</w>"


@lru_cache(2)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class _Chunks:
    """Ids of chunks, as 32-bit integers.

    The tokenizer drops white space and splits there, and it splits between an ASCII letter or digit and
    the punctuation after it, so a text's ids are those of its words and of the punctuation at their ends, one after the other.
    Equal chunks of a block are found by hashes and compared byte by byte. New ones are encoded many at a time, as a
    text of their own, and told apart by what their tokens spell. ASCII capitals are lower-cased first,
    as the tokenizer does, which makes more of the chunks equal."""

    def __init__(self, path: str):
        tokenizer, of = _tokenizer(path), byte_characters()
        self.encode, self.known, self.before = tokenizer.encode_batch_fast, {}, {}
        vocabulary = tokenizer.get_vocab()
        self.spelled = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.spelled[i] = bytes(map(of.__getitem__, token.removesuffix(WORD_END)))
        self.lengths = np.fromiter(map(len, self.spelled), np.int64, len(self.spelled))

    def one_by_one(self, chunks: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self.encode([c.decode() for c in chunks], add_special_tokens=False)] if chunks else []

    def coded(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of chunks without special strings. Those whose tokens don't spell them in small letters are found by halving and encoded alone."""
        if len(chunks) < 2:
            return self.one_by_one(chunks)
        text = b" ".join(chunks).decode()
        spelled = unicodedata.normalize("NFC", text).lower()
        ids = self.encode([text], add_special_tokens=False)[0].ids
        words = spelled.encode().split(b" ")
        if len(words) != len(chunks) or b"".join(map(self.spelled.__getitem__, ids)) != b"".join(words):
            half = len(chunks) // 2
            return self.coded(chunks[:half]) + self.coded(chunks[half:])
        ids, ends = np.array(ids, np.uint32), np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        ends, raw = (4 * (np.searchsorted(np.cumsum(self.lengths[ids]), ends) + 1)).tolist(), ids.tobytes()
        return [raw[a:z] for a, z in zip([0, *ends], ends)]  # noqa: B905

    def learn(self, chunks: list[bytes]) -> dict[bytes, bytes]:
        plain, odd = [c for c in chunks if c.isascii()], []
        for c in chunks if len(plain) < len(chunks) else ():  # other white space than between chunks is not spelled
            if not c.isascii():
                (plain if len(c.decode().split()) == 1 else odd).append(c)
        if b"<|" in b" ".join(plain):
            odd += [c for c in plain if b"<|" in c]
            plain = [c for c in plain if b"<|" not in c]
        return dict(zip(plain + odd, self.coded(plain) + self.one_by_one(odd), strict=True))

    def look_up(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of distinct chunks. Half of what is remembered is forgotten at a time: what was not asked for since the half before."""
        found = list(map(self.known.get, chunks))
        if missing := [i for i, ids in enumerate(found) if ids is None]:
            asked = [chunks[i] for i in missing]
            again = list(map(self.before.get, asked))
            learned = self.learn([c for c, ids in zip(asked, again, strict=True) if ids is None])
            again = [learned[c] if ids is None else ids for c, ids in zip(asked, again, strict=True)]
            for i, ids in zip(missing, again, strict=True):
                found[i] = ids
            if len(self.known) + len(missing) > REMEMBERED // 2:
                self.before, self.known = self.known, {}
            self.known.update(zip(asked, again, strict=True))
            for chunk in asked:
                if len(chunk) > REMEMBERED_LENGTH:
                    del self.known[chunk]
        return found

    def part(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, sums: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, ...]:
        """The ids of the chunks of a block one after the other, where each chunk starts and how many ids it has."""
        raw = data.tobytes()
        if b"<|" not in raw:
            last = np.maximum.accumulate(np.where(_PUNCTUATION[data], -1, np.arange(len(data))))[ends - 1] + 1
            cut = (last > starts) & (last < ends) & _LETTER[data[last - 1]]
            starts, ends = np.sort(np.append(starts, last[cut])), np.sort(np.append(ends, last[cut]))
        hashes, lengths = mix((sums[ends] - sums[starts]) * down[starts]), ends - starts
        _, first, of = np.unique(hashes, return_index=True, return_inverse=True)
        like = first[of]
        same = (lengths == lengths[like]).all()
        if same:
            again = np.flatnonzero(like != np.arange(len(like)))
            size, start = lengths[again], starts[again]
            place = np.repeat(start - (np.cumsum(size) - size), size)
            place += np.arange(len(place))
            same = (data[place] == data[place + np.repeat(starts[like[again]] - start, size)]).all()
        if same:
            ids = self.look_up([raw[a:z] for a, z in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        else:  # different chunks of one hash
            chunks = [raw[a:z] for a, z in zip(starts.tolist(), ends.tolist(), strict=True)]
            number = {c: i for i, c in enumerate(dict.fromkeys(chunks))}
            ids, of = self.look_up(list(number)), np.fromiter(map(number.__getitem__, chunks), np.int64, len(chunks))
        n = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        begin, size = (np.cumsum(n) - n)[of], n[of]
        place = np.repeat(begin - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        return np.frombuffer(b"".join(ids), np.uint32)[place], starts, size

    def ids(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """The ids of each text. Texts of ``LEARNED`` bytes go together; a longer one goes by blocks."""
        at = 0
        while at < len(texts):
            held, size = [], -1
            while at < len(texts) and (not held or size + 1 + len(texts[at] or b"") <= LEARNED):
                text = texts[at] or b""
                # ASCII capitals are lower-cased, as the tokenizer does after it looked for special strings and composed letters
                # with marks behind them (U+0300 to U+037F, bytes 0xCC and 0xCD): texts with either are left as they are.
                held.append(text if b"<|" in text or b"\xcc" in text or b"\xcd" in text else text.lower())
                size, at = size + 1 + len(text), at + 1
            blocks = _blocks(b" ".join(held), BY_SPACE)
            if len(held) == 1:
                yield b"".join([self.part(*block)[0].tobytes() for block in blocks])
            elif (block := next(blocks, None)) is None:
                yield from [b""] * len(held)
            else:
                ids, starts, n = self.part(*block)
                begins = np.cumsum([0, *(len(x) + 1 for x in held)])
                upto = 4 * np.append(0, np.cumsum(n))[np.searchsorted(starts, begins)]
                raw = ids.tobytes()
                for a, z in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True):
                    yield raw[a:z]


@lru_cache(2)
def _chunks(path: str) -> _Chunks:
    return _Chunks(path)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """The token sequences to pack: per document its ids and ``END``, cut into
    pieces of ``capacity`` only where longer. ``doc_id``, ``piece``, ``start``,
    ``length``, ``ids_crc32`` and, if asked for, ``ids`` (32-bit little-endian).

    Null and empty texts are ``END`` alone. Repeated rows are packed each."""

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        chunks, rows = _chunks(path), []
        for doc, ids in zip(batch.column(0).to_pylist(), chunks.ids(batch.column(1).cast(pa.binary()).to_pylist()), strict=True):
            ids += END.to_bytes(4, "little")
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
        doc, piece, start, length, crc, ids = zip(*rows, strict=True)
        columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.record_batch([*columns, pa.array(ids, pa.binary())] if with_ids else columns, [*names, "ids"] if with_ids else names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


Pattern = tuple[int, list[tuple[int, int]]]


def fullest(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """The fullest combination that holds the longest item left: (length, how
    often), longest first. Reachable sums are bits of one integer; an item
    shifts them, and the sums before each item lead back to the combination."""
    longest = max(counts)
    room, reach, steps = capacity - longest, 1, []
    mask = (1 << room + 1) - 1
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, times = min(counts[length] - (length == longest), room // length), 1
        while left > 0 and not reach >> room & 1:
            take = min(times, left)
            steps.append((length, take, reach))
            reach |= reach << take * length & mask
            left, times = left - take, times * 2
        if reach >> room & 1:
            break
    total, taken = reach.bit_length() - 1, {longest: 1}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            taken[length] = taken.get(length, 0) + take
            total -= take * length
    return sorted(taken.items(), reverse=True)


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Bins for items given as length -> how many: (number of bins, combination).

    Each bin is the fullest combination of what is left, which is then removed.
    The same combination would be found again as long as its items last, so it
    is removed that many times at once: the work depends on the number of
    different lengths, not of items."""
    counts, bins = {k: v for k, v in counts.items() if v > 0}, []
    while counts:
        combination = fullest(counts, capacity)
        times = min(counts[length] // n for length, n in combination)
        bins.append((times, combination))
        for length, n in combination:
            counts[length] -= times * n
            if not counts[length]:
                del counts[length]
    return bins


def _places(bins: list[Pattern]) -> tuple[np.ndarray, ...]:
    """For runs of items of equal length: length and rank of the first, bin of
    the first, items a bin, offset in the bin."""
    rows, ranks, base = [], {}, 0
    for times, combination in bins:
        offset = 0
        for length, n in combination:
            rows.append((length, ranks.get(length, 0), base, n, offset))
            ranks[length] = ranks.get(length, 0) + times * n
            offset += length * n
        base += times
    return tuple(np.array(sorted(rows), np.int64).reshape(-1, 5).T)


def pack(spark: SparkSession, pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, in as few sequences of
    ``capacity`` as minimum bin slack finds for the lengths of all pieces.

    Only the number of pieces of each length comes to the driver, ``capacity``
    numbers at most, and the combinations for them go back. Each piece finds
    its place by its rank among those of its length; ranks are counted in
    ``GROUPS`` groups a length, so that a length that many share is no single
    task's. No pieces give no rows. ``pieces`` must give the same rows again
    when read again, as a written table does."""
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = spark.sparkContext.broadcast(_places(minimum_bin_slack(counts, capacity)))

    grouped = pieces.select(F.struct(*pieces.columns).alias("row"), "length", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(GROUPS)).alias("part"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = grouped.groupBy("length", "part").count()
    parts = parts.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy("row.doc_id", "row.piece")
    # parts has capacity * GROUPS rows at most.
    ranked = grouped.withColumn("rank", F.row_number().over(within) - 1).join(F.broadcast(parts), ["length", "part"])
    ranked = ranked.select("row", "length", (F.col("before") + F.col("rank")).alias("rank"))

    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        lengths, firsts, bins, n, offsets = places.value
        length, rank = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        at = np.searchsorted(lengths << 40 | firsts, length << 40 | rank, "right") - 1
        index = rank - firsts[at]
        sequence, offset = bins[at] + index // n[at], offsets[at] + index % n[at] * length
        return pa.record_batch([batch.column(0), pa.array(sequence), pa.array(offset)], ["row", "sequence_id", "offset"])

    out = ranked.mapInArrow(run, f"row {ranked.schema['row'].dataType.simpleString()}, sequence_id long, offset long")
    return out.select("row.*", "sequence_id", "offset")


def pack_documents(spark: SparkSession, docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Tokenizes ``docs`` (``doc_id``, ``text``) and packs the pieces."""
    return pack(spark, written(spark, token_pieces(docs, path, capacity, with_ids), "pieces"), capacity)


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return pack_documents(spark, docs, public_tokenizers.path(TOKENIZER), with_ids=False)
