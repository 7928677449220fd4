"""Near-duplicate documents by an inverted join of MinHash signature coordinates."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kindling.llm.common import LOWER, UPPER, binary_array, mix, per_batch, shingles, table, utf8
from kindling.llm.common import written as _written
from kindling.llm.components import connected_components

#: Coordinates of a signature, and how many two signatures must share for their sets to be compared.
#: At a similarity of 0.8 the shared coordinates are binomial (64, 0.8): fewer than 34 have a probability of 3.2e-7.
#: (128 coordinates and 80 matches miss 1.4e-6 and post 56 pairs a document instead of 38.)
COORDINATES, MATCHES = 64, 34
#: By the prefix rule, sets with that many shared coordinates share MEETINGS among the first PREFIX of either, in any common order.
MEETINGS = 8
PREFIX = COORDINATES - MATCHES + MEETINGS
#: Pairs that a class shares with no other match nothing, so a class needs MATCHES shared ones; classes that fall short are left out this often.
ROUNDS = 2
_U64 = np.uint64
_FACTORS = mix(np.arange(1, COORDINATES + 1, dtype=_U64) * _U64(0xD1342543DE82EF95)) | _U64(1)
_OFFSETS = mix(np.arange(1, COORDINATES + 1, dtype=_U64) * _U64(0xAEF17502108EF2D9))
_NO_ID = (1 << 63) - 1
#: About how many members (1 MB of brief signatures), and members of how many shingles, are held in memory to compare others with.
BLOCK_MEMBERS, BLOCK_SHINGLES = 16384, 1_000_000
#: About how many groups a piece of a list has.
LIST_PIECE = 1024


#: Tables of this module are written smaller than by Parquet's usual codec.
written = partial(_written, codec="zstd")


def signature(found: np.ndarray) -> np.ndarray:
    """The least value of each coordinate's permutation, 32 bits of it."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, _U64)
    for at in range(0, len(found), 4096):
        part = found[at:at + 4096, None] * _FACTORS
        part ^= part >> _U64(29)
        part *= _OFFSETS | _U64(1)
        np.minimum(least, part.min(0), out=least)
    return (mix(least) >> _U64(32)).astype(np.uint32)


def _tokens(signatures: np.ndarray) -> np.ndarray:
    """A key for each coordinate-value pair: its 32 bits and the coordinate's number. Left as they are, the bytes of it
    that are 0 cost next to nothing in shuffles and tables, which hold such keys above all."""
    return signatures.astype(_U64) << _U64(8) | np.arange(COORDINATES, dtype=_U64)


def _brief(signature: np.ndarray) -> bytes:
    """The lowest byte of each coordinate: what matches in full matches here, and 1 in 256 of the rest."""
    return signature.astype(np.uint8).tobytes()


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def _sets(n_words: int):
    @per_batch
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, digests, signatures, briefs = [], [], [], []
        for text in utf8(batch.column(1)):
            found = shingles(text, n_words)
            sizes.append(len(found))
            digests.append(blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
            least = signature(found) if len(found) else None
            signatures.append(None if least is None else least.tobytes())
            briefs.append(None if least is None else _brief(least))
        return pa.record_batch([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), *map(binary_array, (digests, signatures, briefs))],
                               ["doc_id", "text_hash", "n_shingles", "digest", "signature", "brief"])

    return run


@per_batch
def _pairs(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each class's coordinate-value pairs, a row each."""
    tokens = _tokens(_signatures(batch.column(2))).view(np.int64)
    node, size = (np.repeat(batch.column(i).to_numpy(), COORDINATES) for i in (0, 1))
    return pa.record_batch([pa.array(tokens.ravel()), pa.array(node), pa.array(size)], ["token", "node", "size"])


def _shared(pairs: DataFrame) -> DataFrame:
    """``pairs`` that two classes or more have, with how ``many``. A pair that very many have is one partial
    count a task, and its rows meet a single row, so they can be split."""
    many = pairs.groupBy("token").agg(F.count("*").alias("many")).where("many > 1")
    return pairs.join(many, "token")


class _Block:
    """Members of one group that others are held against: node, component, tag and payload of each."""

    def __init__(self):
        self.rows, self.payloads = [], []

    def add(self, row: tuple[int, int, int], payload) -> None:
        self.rows.append(row)
        self.payloads.append(payload)

    def ready(self) -> None:
        self.node, self.component, self.tag = np.array(self.rows).T


class _BySignature(_Block):
    """Counts the coordinates in which a brief signature collides with each member's."""

    def ready(self) -> None:
        super().ready()
        self.matrix = np.frombuffer(b"".join(self.payloads), np.uint8).reshape(-1, COORDINATES)

    def hits(self, payload: bytes) -> np.ndarray:
        return np.count_nonzero(self.matrix == np.frombuffer(payload, np.uint8), axis=1) >= MATCHES


class _BySet(_Block):
    """Compares full sets of shingles, by an index of the members' shingles."""

    def __init__(self, n_words: int, percent: int):
        super().__init__()
        self.n_words, self.percent = n_words, percent

    def ready(self) -> None:
        super().ready()
        sets = [shingles(x, self.n_words) for x in self.payloads]
        self.sizes = np.array([len(x) for x in sets])
        values, owners = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.sizes)
        order = np.argsort(values, kind="stable")
        self.values, self.owners, self.payloads = values[order], owners[order], []

    def hits(self, payload: bytes) -> np.ndarray:
        found = shingles(payload, self.n_words)
        start, end = np.searchsorted(self.values, found, "left"), np.searchsorted(self.values, found, "right")
        n = end - start
        at = np.repeat(start - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        shared = np.bincount(self.owners[at], minlength=len(self.sizes))
        return 100 * shared >= self.percent * (self.sizes + len(found) - shared)


def _meet(new_block):
    """Streams rows (group, block, salt, kind, node, component, tag, payload),
    members before those held against them: pairs of different components that
    hit, for each ``b`` one of each tag."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block, ready = None, None, False
        for batch in batches:
            out = []
            payloads = batch.column(7).cast(pa.binary()).to_pylist()
            for *key, kind, node, component, tag, payload in zip(*(batch.column(i).to_pylist() for i in range(7)), payloads, strict=True):
                if key != now:
                    now, block, ready = key, new_block(), False
                if not kind:
                    block.add((node, component, tag), payload)
                    continue
                if not ready:
                    block.ready()
                    ready = True
                at = np.flatnonzero(block.hits(payload) & (block.component != component))
                for other in at[np.unique(block.tag[at], return_index=True)[1]]:
                    out.append((key[0], block.tag[other], block.node[other], node))
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["group", "tag", "a", "b"])

    return run


def _near_size(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _frequent(lists: list[np.ndarray]) -> np.ndarray:
    """The numbers that ``MEETINGS`` of the ascending ``lists`` have, by skip merging.

    The ``MEETINGS`` - 1 longest lists are not merged: a number that is frequent is in one of the
    others, too. What the others have is counted, and then only looked up in the long ones."""
    lists = sorted(lists, key=len)
    if len(lists) < MEETINGS:
        return np.empty(0, np.int64)
    found, times = np.unique(np.concatenate(lists[:1 - MEETINGS]), return_counts=True)
    for i, long in enumerate(lists[1 - MEETINGS:]):
        alive = times + (MEETINGS - 1 - i) >= MEETINGS
        found, times = found[alive], times[alive]
        times = times + (long[np.minimum(np.searchsorted(long, found), len(long) - 1)] == found)
    return found[times >= MEETINGS]


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Streams rows (node, token, groups) by node and token: the groups that each node meets in ``MEETINGS`` lists."""
    now, token, lists = None, None, []
    for batch in batches:
        nodes, groups = [], []

        def end(node, lists) -> None:
            found = _frequent([x[0] if len(x) == 1 else np.unique(np.concatenate(x)) for x in lists])  # noqa: B023
            nodes.append(np.full(len(found), node, np.int64))  # noqa: B023
            groups.append(found)  # noqa: B023

        values, ends = batch.column(2).values.to_numpy(), batch.column(2).offsets.to_numpy()
        for i, (node, own) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if node != now:
                if now is not None:
                    end(now, lists)
                now, token, lists = node, None, []
            part = np.sort(values[ends[i]:ends[i + 1]])
            if own == token:
                lists[-1].append(part)
            else:
                token = own
                lists.append([part])
        if nodes:
            yield pa.record_batch([pa.array(np.concatenate(nodes)), pa.array(np.concatenate(groups))], ["node", "group"])
    if now is not None:
        found = _frequent([x[0] if len(x) == 1 else np.unique(np.concatenate(x)) for x in lists])
        yield pa.record_batch([pa.array(np.full(len(found), now, np.int64)), pa.array(found)], ["node", "group"])


def _beside(band: str) -> Column:
    return F.explode(F.array(*(F.col(band) + i for i in (-1, 0, 1)))).alias("band")


def _meeting(spark: SparkSession, named: DataFrame, percent: int) -> DataFrame:
    """Postings, with their ``band`` of size, under which a class can meet a component that is not its own: in its band or
    one beside it, as one band is the widest ratio that links have. A class without ``MEETINGS`` of them has no link left."""
    band = F.floor(F.log(F.col("size").cast("double")) / math.log(100 / percent) + 1e-9) if percent < 100 else F.col("size")
    named = written(spark, named.withColumn("band", band), "named-postings")
    ends = named.groupBy("token", "band").agg(F.min("rank").alias("low"), F.max("rank").alias("high")).select("token", _beside("band"), "low", "high")
    ends = ends.groupBy("token", "band").agg(F.min("low").alias("low"), F.max("high").alias("high")).where(F.col("low") < F.col("high"))
    mixed = named.join(ends.select("token", "band"), ["token", "band"])
    many = mixed.groupBy("node").count().where(F.col("count") >= MEETINGS).select("node")
    return written(spark, mixed.join(many, "node"), "meeting-postings")


def _tries(spark: SparkSession, mixed: DataFrame) -> DataFrame:
    """``group``, ``node``, ``component``: the groups against which each class must be held.

    A list of the groups under a pair is cut by bands of size: a band's list
    has the groups of the bands beside it, too, and a class meets its own band's list alone. Lists are cut into pieces of about ``LIST_PIECE`` groups. A class's lists
    come together in one place, sorted, and are merged there. A link shares ``MEETINGS`` lists, so a class meets the group of a link's other end
    in as many; it is held against groups that have a component greater than its own."""
    entries = mixed.select("token", "band", "group").distinct().select("token", _beside("band"), "group").distinct()
    pieces = entries.groupBy("token", "band").agg(F.ceil(F.count("*") / LIST_PIECE).alias("pieces"))
    piece = F.pmod(F.xxhash64("group"), F.col("pieces")).alias("piece")
    lists = entries.join(pieces, ["token", "band"]).select("token", "band", "group", piece).groupBy("token", "band", "piece").agg(F.collect_list("group").alias("groups"))
    rows = mixed.select("node", "token", "band").join(lists, ["token", "band"]).select("node", "token", "groups")
    met = rows.repartition("node").sortWithinPartitions("node", "token").mapInArrow(_merged, "node long, group long")
    nodes = mixed.groupBy("node").agg(F.first("rank").alias("rank"))
    greatest = mixed.groupBy("group").agg(F.max("rank").alias("greatest"))
    tried = met.join(nodes, "node").join(greatest, "group").where(F.col("rank") < F.col("greatest"))
    return tried.select("group", "node", F.col("rank.component").alias("component"))


def _known_id(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("long"), F.lit(_NO_ID))


class _Corpus:
    """Documents as classes of equal shingle sets, each under one node."""

    def __init__(self, spark: SparkSession, docs: DataFrame, n_words: int, percent: int):
        self.spark, self.n_words, self.percent = spark, n_words, percent
        self.docs = docs.select(_known_id(F.col("doc_id")).alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
        self.sets = written(spark, self.docs.mapInArrow(_sets(n_words), "doc_id long, text_hash long, n_shingles long, digest binary, signature binary, brief binary"), "shingle-sets")
        some = self.sets.where("digest IS NOT NULL")
        classes = some.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").alias("doc"), "text_hash")).alias("head"), F.min("n_shingles").alias("size"),
                                             F.first(F.struct("signature", "brief")).alias("minima"))
        # A class is known by its smallest document. Where texts share a doc_id, the others are known by their digest, below 0.
        # Signatures stay where the digests' groups are; only ids and digests are dealt by document.
        # The least digest of a document is found before and after a shuffle: an id that very many rows share is no single task's.
        named = some.groupBy("digest").agg(F.min("doc_id").alias("doc"))
        first = named.groupBy("doc").agg(F.min("digest").alias("digest")).select("digest", F.lit(True).alias("first"))
        classes = classes.join(first, "digest", "left")
        other = -1 - F.xxhash64("digest").bitwiseAND(F.lit((1 << 62) - 1))
        node = F.when(F.col("first"), F.col("head.doc")).otherwise(other).alias("node")
        classes = classes.select("digest", "head.*", "size", "minima.*", node)
        self.classes = written(spark, classes, "shingle-classes")

    def postings(self) -> DataFrame:
        """``token``, ``node``, ``size``, ``many``: each class under the rarest coordinate-value pairs of its
        signature, by their exact counts, where two classes or more meet.

        A class with fewer than ``MATCHES`` shared pairs is linked with nothing; without it others' pairs are shared less, so this is done
        ``ROUNDS`` times. Pairs that are not shared come first in the common order and take their places in the prefix."""
        pairs = self.classes.select("node", "size", "signature").mapInArrow(_pairs, "token long, node long, size long")
        of_class = Window.partitionBy("node")  # COORDINATES rows at most
        for _ in range(ROUNDS):
            found = _shared(pairs).withColumn("_shared", F.count("*").over(of_class)).where(F.col("_shared") >= MATCHES)
            pairs = written(self.spark, found.drop("_shared", "many"), "shared-pairs")
        ranked = _shared(pairs).withColumn("_place", COORDINATES - F.count("*").over(of_class) + F.row_number().over(of_class.orderBy("many", "token")))
        first = written(self.spark, ranked.where(F.col("_place") <= PREFIX).select("token", "node", "size"), "prefixes")
        return written(self.spark, _shared(first), "postings")

    def texts(self, nodes: DataFrame) -> DataFrame:
        """``node`` and ``payload``, one text of the class, for the classes of ``nodes``."""
        wanted = nodes.select("node").distinct().join(self.classes.select("node", "doc", F.col("text_hash").alias("own")), "node")
        rows = self.docs.join(wanted, (F.col("doc_id") == F.col("doc")) & (F.col("text_hash") == F.col("own")))
        # Rows that repeat an id and a text are one before they are shuffled.
        return written(self.spark, rows.groupBy("node").agg(F.first("text").alias("payload")), "texts")

    def signatures(self) -> DataFrame:
        return self.classes.select("node", F.col("brief").alias("payload"))

    def met(self, members: DataFrame, others: DataFrame, payloads: DataFrame, new_block, copy_for: int) -> DataFrame:
        """Holds ``others`` (``group``, ``block``, ``node``, ``component``) against
        ``members`` (the same, and ``tag``) of their group and block, by what
        ``payloads`` has of their nodes. A block is copied for every ``copy_for``
        that are held against it."""
        many = others.groupBy("group", "block").agg(F.ceil(F.count("*") / copy_for).alias("parts"))
        dealt = others.join(many, ["group", "block"]).withColumn("salt", F.pmod(F.xxhash64("node"), F.col("parts")))
        dealt = dealt.withColumn("kind", F.lit(1)).withColumn("tag", F.lit(0).cast("long"))
        held = members.join(many, ["group", "block"]).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).withColumn("kind", F.lit(0))
        columns = ["group", "block", "salt", "kind", "node", "component", "tag"]
        rows = held.select(columns).unionByName(dealt.select(columns)).join(payloads, "node").select(*columns, "payload")
        rows = rows.repartition("group", "block", "salt").sortWithinPartitions("group", "block", "salt", "kind")
        return rows.mapInArrow(_meet(new_block), "group long, tag long, a long, b long")


def _linked_rows(spark: SparkSession, docs: DataFrame, n_words: int, percent: int) -> DataFrame:
    """``doc_id`` (``_NO_ID`` for null), ``text_hash``, ``n_shingles`` and ``smallest`` (``doc`` and
    ``text_hash`` of the smallest row of the component; null without shingles) of every row of ``docs``."""
    corpus = _Corpus(spark, docs, n_words, percent)
    postings = corpus.postings()
    signatures = corpus.signatures()
    by_set = lambda: _BySet(n_words, percent)
    one = F.lit(0).cast("long")

    # The head of a list is its member that meets the most others in all its lists: of edited copies, the original.
    ranks = postings.groupBy("node").agg(F.sum("many").alias("met"))
    heads = postings.join(ranks, "node").groupBy("token").agg(F.max(F.struct("met", F.negate("node").alias("node"), "size")).alias("head"))
    star = postings.join(heads, "token").select(F.negate("head.node").alias("group"), "node", "size", F.col("head.size").alias("head_size"))
    star = star.where((F.col("group") != F.col("node")) & _near_size(F.col("size"), F.col("head_size"), percent)).groupBy("group", "node").count()
    # Each class goes to the head with which it shares the most lists.
    group = star.groupBy("node").agg(F.max(F.struct("count", F.negate("group").alias("group"))).alias("best"))
    group = written(spark, group.select("node", F.negate("best.group").alias("group"), F.col("best.count").alias("count")), "groups")
    # Those that share few lists with their head are no links of it, or else are tried with all that is left.
    others = group.where(F.col("count") >= MEETINGS).select("group", one.alias("block"), "node", F.col("node").alias("component"))
    alone = group.select("group").distinct().select("group", one.alias("block"), F.col("group").alias("node"), F.col("group").alias("component"), one.alias("tag"))
    like = corpus.met(alone, others, signatures, _BySignature, 2048).select("group", one.alias("block"), F.col("b").alias("node"), F.col("b").alias("component"))
    like = written(spark, like, "like-heads")
    texts = corpus.texts(like.select("node").unionByName(like.select(F.col("group").alias("node"))))
    first = written(spark, corpus.met(alone, like, texts, by_set, 512).select("a", "b"), "first-links")
    known = connected_components(spark, first)

    # What is left: lists in which different components meet. A class is held against the groups there that have a greater component.
    sizes = known.groupBy("component").count()
    ranked = known.join(sizes, "component").select("node", "component", "count")
    rank = F.struct(F.coalesce("count", F.lit(1)).alias("count"), F.coalesce("component", "node").alias("component"))
    named = postings.join(ranked, "node", "left").join(group.drop("count"), "node", "left").select("token", "node", "size", F.coalesce("group", "node").alias("group"), rank.alias("rank"))
    mixed = _meeting(spark, named, percent)
    tries = written(spark, _tries(spark, mixed), "tries")

    # Signatures are compared in blocks of many members; they say against which smaller blocks of sets a class must be held.
    members = mixed.select("group", "node", "size", F.col("rank.component").alias("component")).distinct()
    members = members.join(tries.select("group").distinct(), "group")
    split = members.groupBy("group").agg(F.ceil(F.count("*") / BLOCK_MEMBERS).alias("blocks"), F.ceil(F.sum("size") / BLOCK_SHINGLES).alias("parts"))
    members = members.join(split, "group").select("group", "node", "component", *(F.pmod(F.xxhash64("node"), F.col(n)).alias(c) for c, n in (("block", "blocks"), ("part", "parts"))))
    members = written(spark, members, "members")
    spread = tries.join(split, "group").withColumn("block", F.explode(F.sequence(one, F.col("blocks") - 1))).select("group", "block", "node", "component")
    like = corpus.met(members.withColumnRenamed("part", "tag"), spread, signatures, _BySignature, 2048)
    like = like.select("group", F.col("tag").alias("block"), F.col("b").alias("node")).distinct().join(tries, ["group", "node"])
    like = written(spark, like, "matching")
    members = members.select("group", F.col("part").alias("block"), "node", "component", F.col("component").alias("tag"))
    members = written(spark, members.join(like.select("group", "block").distinct(), ["group", "block"]), "matching-members")
    texts = corpus.texts(like.select("node").unionByName(members.select("node")))
    found = corpus.met(members, like, texts, by_set, 512)
    links = first.unionByName(found.select("a", "b"))
    found = connected_components(spark, links)

    classes = corpus.classes.select("digest", "node", "doc", "text_hash").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    smallest = classes.groupBy("component").agg(F.min(F.struct("doc", "text_hash")).alias("smallest"))
    classes = written(spark, classes.join(smallest, "component").select(F.col("digest").alias("same"), "smallest"), "class-components")
    rows = corpus.sets.select("doc_id", "text_hash", "n_shingles", "digest").join(classes, F.col("digest") == F.col("same"), "left")
    return rows.select("doc_id", "text_hash", "n_shingles", "smallest")


def near_duplicates(spark: SparkSession, docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (the smallest ``doc_id``
    reachable by links) of every row of ``docs``. Linked are documents whose
    sets of distinct ``n_words``-word shingles have a Jaccard similarity of at
    least ``percent`` %; a text of fewer words is one shingle.

    Documents of equal sets are one class. A class is posted under the rarest
    coordinate-value pairs of its MinHash signature, by exact counts: so many that two classes
    with ``MATCHES`` shared coordinates have ``MEETINGS`` postings in common. All members
    of a posting list are held against its first; components of the links found
    so then leave only pairs of different components to be tried, which are
    all tried: a list of thousands of copies costs as many comparisons, not
    their square, and no link is left out. A pair is tried by the number of
    coordinates that match, then by its full sets. A link of similarity 0.8
    itself is missed with a probability under 1e-6, by a signature that falls
    short of ``MATCHES``; linked documents of a group have many such chances.

    Null and empty texts have no set and are linked with nothing. Every row is
    a document of its own, linked by its text alone: rows that share a
    ``doc_id`` but not a component have one ``component_id`` each, and join no
    components. Null ids come after all others; components of rows without ids
    are told apart by no ``component_id``. No rows give no rows; other columns
    are not read."""
    rows = _linked_rows(spark, docs, n_words, percent)
    real = lambda c: F.nullif(c, F.lit(_NO_ID))
    return rows.select(real(F.col("doc_id")).alias("doc_id"), "n_shingles", real(F.coalesce("smallest.doc", "doc_id")).alias("component_id"))


def one_of_each(spark: SparkSession, docs: DataFrame, n_words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``docs`` for each component: of its smallest ``doc_id`` (null
    after all others), and of that id's texts one. Rows whose texts are linked
    with nothing stay, whatever id they share; of rows equal in ``doc_id`` and
    text, one."""
    found = _linked_rows(spark, docs, n_words, percent)
    gone = found.where(F.struct(F.col("doc_id").alias("doc"), "text_hash") != F.col("smallest"))
    gone = gone.select(F.col("doc_id").alias("gone"), F.col("text_hash").alias("gone_hash")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    same = (_known_id(F.col("row.doc_id")) == F.col("gone")) & (F.xxhash64("row.text") == F.col("gone_hash"))
    return rows.join(gone, same, "left_anti").select("row.*").dropDuplicates(["doc_id", "text"])


def op5_minhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark, table(spark, sf_dir, "documents", "doc_id", "text"), n_words=2)
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP5_SQL = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
), classes AS (
  SELECT min(doc_id) AS node, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s
), postings AS (
  SELECT node, n, unnest(s) AS x FROM classes
), links AS (
  SELECT a.node AS a, b.node AS b FROM postings a JOIN postings b ON a.x = b.x AND a.node <> b.node AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))
), reach AS (
  SELECT node AS a, node AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), smallest AS (
  SELECT a AS node, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(m.component_id, d.doc_id) = d.doc_id AS kept
FROM sets d LEFT JOIN classes c ON list_sort(d.s) = c.s LEFT JOIN smallest m ON m.node = c.node
"""
