"""Language-model scoring of whole texts: a unigram base and a gated recurrent model.

Counting.  Words of all training texts are counted, per partition and then in
Spark.  The at most ``broadcast_words`` most frequent ones go to the scoring
tasks; the counts of all others are joined to the texts that hold them.

Symbols.  The most frequent words are symbols of the recurrent model; how many grows
with the cube root of the corpus (``heads_of``).  Every other word, seen or not, belongs
to one of ``GROUPS`` groups by its last bytes; the model predicts the group and the word's
share in the group comes from the corpus counts, so every text has a proper probability.
Texts are split into symbols once; the table of them is trained on and scored.

Training.  Every training text is dealt by hash to one round and one shard; there
are as many shards as keep a round's slice of one at about ``train_tokens`` tokens, so
their number grows with the corpus.  After each round the shards' weights are
averaged, by tokens: summed in their tasks, then by block of the weights, so the
driver gets one model whatever the number of shards.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces_of, single_threaded_tasks, stored
from .gru import LANES, Gru

END = b""                 # no word is empty, so this is the end token's key
GROUPS, _SUFFIX = 64, 3   # groups of rarer words, by that many last bytes
_HELD_WORDS = 2_500_000    # words a counting task holds before it emits their counts
_PIECE = 4 << 20          # bytes of text that are split at once, a longer text alone
_BLOCKS = 64              # parts of the weights that are averaged apart
_HELD_TOKENS = 1_500_000  # tokens a scoring task gathers before it scores them, up to four
                          # times as many where a long text would leave lanes empty


@dataclass(frozen=True)
class Settings:
    broadcast_words: int = 200_000    # bound of what the scoring tasks are sent
    heads: int | None = None          # symbols of the recurrent model, a multiple of
                                      # width; None: by the corpus, see heads_of
    width: int = 32                   # words per class
    hidden: int = 32
    trainers: int = 6                 # shards of a small corpus
    rounds: int = 3
    train_tokens: int = 1_200_000      # about a slice's tokens (a shard's in one round)


def held_out(id_col: Column) -> Column:
    """crc32 of the id's text mod 5 is 1; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 1, F.lit(False))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, pa.Array]]:
    """The same rows a piece at a time; the words of each row's text, that is how many
    there are in each, and all of them."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(at)), 0).to_numpy())
        a = 0
        while a < batch.num_rows:
            done = ends[a - 1] if a else 0
            z = max(a + 1, int(np.searchsorted(ends, done + _PIECE, "right")))
            b = batch.slice(a, z - a)
            yield b, *_words(b.column(at))
            a = z


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    texts = pc.fill_null(texts.cast(pa.string()), "")
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    # a text that begins or ends with a blank has an empty string there
    words = split.flatten()
    some = pc.greater(pc.binary_length(words), 0)
    before = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    offsets = split.offsets.to_numpy()
    return np.diff(before[offsets - offsets[0]]), words.filter(some).cast(pa.binary())


def token_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of column ``text``, the end tokens included."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, rows = [], 0, 0
        for b, sizes, words in _pieces(batches):
            held.append(words)
            size, rows = size + len(words), rows + b.num_rows
            if size >= _HELD_WORDS:
                yield counted(held)
                held, size = [], 0
        if size:
            yield counted(held)
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([END], pa.binary()), pa.array([rows], pa.int64())], names=["word", "n"])

    def counted(held: list[pa.Array]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            pc.value_counts(pa.chunked_array(held)).flatten(), names=["word", "n"])

    return (texts.select("text").mapInArrow(count, "word binary, n long")
            .groupBy("word").agg(F.sum("n").alias("c")))


def group_of(word: bytes) -> int:
    return zlib.crc32(word[-_SUFFIX:]) % GROUPS


@dataclass
class Vocabulary:
    """What the scoring tasks know of the counts; logs are to base 10."""

    rank: dict[bytes, int]       # frequent words by falling count
    counts: np.ndarray           # by rank
    symbol: np.ndarray           # by rank
    share: np.ndarray            # by rank: log share in the word's group, 0 for heads
    group_total: np.ndarray      # log of N + 0.5 (V + 1) of each group's words
    total: float                 # the same of all tokens
    tokens: int                  # N
    frequency: np.ndarray        # by symbol
    heads: int


def heads_of(tokens: int, width: int) -> int:
    """Words that are symbols of their own in a corpus of so many tokens: about 1,000 of
    60 M tokens and 4,000 of 4 G, in whole classes of ``width``."""
    return width * max(8, round(tokens ** (1 / 3) / 12))


def vocabulary(counts: DataFrame, most: int, head_words: int | None = None,
               width: int = Settings.width) -> Vocabulary:
    """Frequent words down to the count at which they would be more than ``most``;
    totals over all words.  ``head_words`` None: as many as ``heads_of`` gives."""
    by_count = counts.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
    # words are distinct, so there are at most sqrt(2 N) distinct counts
    least, held = None, 0
    for r in sorted(by_count.collect(), key=lambda r: -r["c"]):
        held += r["n"]
        if held > most:
            break
        least = r["c"]
    frequent = [] if least is None else [
        (bytes(r["word"]), r["c"]) for r in counts.where(F.col("c") >= least).collect()]
    # END is the first symbol, whatever its rank
    frequent.sort(key=lambda x: (x[0] != END, -x[1], x[0]))
    if not frequent or frequent[0][0] != END:
        frequent.insert(0, (END, 0))
    sums = np.zeros((GROUPS, 2))
    tail = F.expr(f"substring(word, -{_SUFFIX}, {_SUFFIX})")
    tail = F.when(F.length("word") <= _SUFFIX, F.col("word")).otherwise(tail)
    for r in (counts.groupBy((F.crc32(tail) % GROUPS).alias("g"))
              .agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).collect()):
        sums[r["g"]] = r["n"], r["v"]
    tokens, distinct = int(sums[:, 0].sum()), int(sums[:, 1].sum())
    head_words = heads_of(tokens, width) if head_words is None else head_words
    c = np.array([x[1] for x in frequent], np.float64)
    group = np.array([group_of(x[0]) for x in frequent])
    heads = np.arange(len(frequent)) < head_words
    seen = c > 0
    np.subtract.at(sums[:, 0], group[heads], c[heads])
    np.subtract.at(sums[:, 1], group[heads & seen], 1)
    group_total = np.log10(sums[:, 0] + 0.5 * (sums[:, 1] + 1))
    symbol = np.where(heads, np.arange(len(frequent)), head_words + group)
    share = np.where(heads, 0.0, np.log10(c + 0.5) - group_total[group])
    first = c[:head_words]
    frequency = np.concatenate((np.pad(first, (0, head_words - len(first))), sums[:, 0]))
    return Vocabulary({w: i for i, (w, _) in enumerate(frequent)}, c, symbol.astype(np.int32), share,
                      group_total, float(np.log10(tokens + 0.5 * (distinct + 1))), tokens, frequency,
                      head_words)


def shards_of(tokens: int, st: Settings) -> int:
    """Shards for so many training tokens."""
    return max(st.trainers, -(-tokens // (st.rounds * st.train_tokens)))


_WORD = T.StructType([T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())])


def encoded(texts: DataFrame, voc_shared, shards: int, st: Settings) -> DataFrame:
    """Every row of (id, text, held_out) once as symbols: uid (unique), id, held_out, turn
    and shard (null: not learned from), h (a random order), symbols, n_tokens, n_known,
    base_score, share, rare.

    The sums are of the words that the vocabulary knows, and the groups' totals of the
    others, whose counts are joined by way of ``rare``."""
    id_type = texts.schema["id"].dataType

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = voc_shared.value
        logs = np.log10(v.counts + 0.5)
        uid = TaskContext.get().partitionId() << 33
        for b, sizes, words in _pieces(batches):
            # of every different word, and of the end token after them
            coded = words.dictionary_encode()
            kinds = [*coded.dictionary.to_pylist(), END]
            rank = np.fromiter(map(v.rank.get, kinds, [-1] * len(kinds)), np.int64, len(kinds))
            unknown = np.flatnonzero(rank < 0)
            group = np.array([group_of(kinds[i]) for i in unknown], np.int64)
            symbol, share, base = v.symbol[rank], v.share[rank], logs[rank]
            known = v.counts[rank] > 0
            # the groups' totals here, the words' counts by the join
            symbol[unknown], share[unknown] = v.heads + group, -v.group_total[group]
            base[unknown], known[unknown] = 0, False
            # every text's words and its end token, one text after the other
            size = sizes + 1
            ends = np.cumsum(size)
            own = np.repeat(np.arange(len(size)), size)
            kind = np.full(len(own), len(kinds) - 1)
            inner = np.ones(len(own), bool)
            inner[ends - 1] = False
            kind[inner] = coded.indices.to_numpy()

            def by_text(of_kind: np.ndarray) -> np.ndarray:
                return np.add.reduceat(of_kind[kind], ends - size)

            offsets = pa.py_buffer((np.append(0, ends) * 4).astype(np.int32))
            syms = pa.py_buffer(symbol[kind].astype("<i4"))
            rare = np.flatnonzero(rank[kind] < 0)
            rare, times = np.unique(own[rare] * len(kinds) + kind[rare], return_counts=True)
            lists = np.append(0, np.cumsum(np.bincount(rare // len(kinds), minlength=len(size))))
            rare = pa.StructArray.from_arrays(
                [coded.dictionary.take(pa.array(rare % len(kinds))), pa.array(times, pa.int64())],
                names=["word", "n"])
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(uid, uid + b.num_rows), pa.int64()), *b.columns[1:],
                 pa.Array.from_buffers(pa.binary(), len(size), [None, offsets, syms]),
                 pa.array(size, pa.int64()), pa.array(by_text(known.astype(np.int64))),
                 pa.array(by_text(base) - size * v.total), pa.array(by_text(share)),
                 pa.ListArray.from_arrays(pa.array(lists, pa.int32()), rare)], names=schema.names)
            uid += b.num_rows

    schema = T.StructType([
        T.StructField("uid", T.LongType()), T.StructField("id", id_type),
        T.StructField("held_out", T.BooleanType()), T.StructField("turn", T.IntegerType()),
        T.StructField("shard", T.IntegerType()), T.StructField("h", T.LongType()),
        T.StructField("symbols", T.BinaryType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
        T.StructField("share", T.DoubleType()), T.StructField("rare", T.ArrayType(_WORD))])
    learned = F.col("id").isNotNull() & ~F.col("held_out")
    rows = texts.withColumn("h", F.xxhash64("id", "text", F.lit(9)))
    turn = F.pmod(F.xxhash64("h"), F.lit(st.rounds)).cast("int")
    shard = F.pmod(F.xxhash64("h", F.lit(1)), F.lit(shards)).cast("int")
    return rows.select("text", "id", "held_out", F.when(learned, turn).alias("turn"),
                       F.when(learned, shard).alias("shard"), "h").mapInArrow(encode, schema)


def fit(dealt: DataFrame, model: Gru, shards: int, st: Settings) -> Gru:
    """Rounds of training by shard, averaging the weights after each."""
    sc = dealt.sparkSession.sparkContext
    # a task trains one shard after the other and sends one sum
    tasks = min(shards, int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sums = "block int, tokens long, mean binary"

    def rows_of(total: dict[int, np.ndarray], tokens: dict[int, int]) -> Iterator[pa.RecordBatch]:
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(total.keys(), pa.int32()), pa.array([tokens[k] for k in total], pa.int64()),
                 pa.array([(v / tokens[k]).astype("<f4").tobytes() for k, v in total.items()],
                          pa.binary())], names=["block", "tokens", "mean"])

    def train(start):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, tokens = {}, 0

            def learn(texts: list[np.ndarray]) -> None:
                nonlocal tokens
                m = start.value
                m = Gru(m.heads, m.width, m.groups, m.hidden, {k: v.copy() for k, v in m.p.items()})
                m.train(texts, st.train_tokens)
                size = sum(map(len, texts))
                flat = np.concatenate([v.ravel() for v in m.p.values()])
                for k, part in enumerate(np.array_split(flat, _BLOCKS)):
                    total[k] = total.get(k, 0) + part.astype(np.float64) * size
                tokens += size

            now, held = None, []
            for b in pieces_of(batches, 256):
                for shard, syms in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if shard != now and held:
                        learn(held)
                        held = []
                    now = shard
                    held.append(np.frombuffer(syms, np.int32))
            if held:
                learn(held)
            yield from rows_of(total, dict.fromkeys(total, tokens))
        return run

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, tokens = {}, Counter()
        for b in pieces_of(batches, 256):
            for k, n, mean in zip(*(c.to_pylist() for c in b.columns)):
                total[k] = total.get(k, 0) + np.frombuffer(mean, "<f4").astype(np.float64) * n
                tokens[k] += n
        yield from rows_of(total, tokens)

    for turn in range(st.rounds):
        start = sc.broadcast(model)
        rows = (dealt.where(F.col("turn") == turn).select("shard", "symbols", "h")
                .repartition(tasks, "shard").sortWithinPartitions("shard", "h")
                .select("shard", "symbols").mapInArrow(train(start), sums)
                .repartition("block").mapInArrow(add, sums).collect())   # one row per block
        if rows:
            flat = np.concatenate([np.frombuffer(r["mean"], "<f4")
                                   for r in sorted(rows, key=lambda r: r["block"])])
            ends = np.cumsum([v.size for v in model.p.values()])
            model = Gru(model.heads, model.width, model.groups, model.hidden, {
                k: part.reshape(model.p[k].shape).astype(np.float32)
                for k, part in zip(model.p, np.split(flat, ends[:-1]))})
    return model


def log_likelihood(table: DataFrame, model: Gru) -> DataFrame:
    """The rows with ``model`` in place of column ``symbols``: their log10 probability."""
    shared = table.sparkSession.sparkContext.broadcast(model)
    names = [c for c in table.columns if c != "symbols"]
    schema = T.StructType([*(table.schema[c] for c in names), T.StructField("model", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def scored() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            texts = [np.frombuffer(x, "<i4") for b in held
                     for x in b.column(b.schema.get_field_index("symbols")).to_pylist()]
            lp = shared.value.score(texts) / np.log(10)
            return pa.RecordBatch.from_arrays(
                [*(rows.column(c).combine_chunks() for c in names), pa.array(lp, pa.float64())],
                names=schema.names)

        held, size, longest = [], 0, 0
        for b in pieces_of(batches, 256):
            held.append(b)
            tokens = pc.divide(pc.binary_length(b.column(b.schema.get_field_index("symbols"))), 4)
            size, longest = size + pc.sum(tokens).as_py(), max(longest, pc.max(tokens).as_py())
            if size >= min(max(_HELD_TOKENS, LANES * longest), 4 * _HELD_TOKENS):
                yield scored()
                held, size, longest = [], 0, 0
        if held:
            yield scored()

    return table.mapInArrow(run, schema)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          st: Settings = Settings()) -> DataFrame:
    """One row per input row: id, held_out, n_tokens, n_known, train_tokens,
    base_score, score (log10 probabilities of the whole text).

    Null and empty texts are their end token alone.  Rows with a null id are
    neither held out nor learned from.  Repeated rows keep their row and count
    as often as they occur.  Without training rows every token's base
    probability is one and the recurrent model is untrained.  Empty input gives
    no rows; other columns are ignored."""
    spark = docs.sparkSession
    single_threaded_tasks(spark)
    src = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"),
                      held_out(F.col(id_col)).alias("held_out"))
    known = src.where(F.col("id").isNotNull() & ~F.col("held_out")).select("id", "text")
    counts = stored(token_counts(known), "lm-counts")
    voc = vocabulary(counts, st.broadcast_words, st.heads, st.width)
    shards = shards_of(voc.tokens, st)
    table = stored(encoded(src, spark.sparkContext.broadcast(voc), shards, st), "lm-symbols")
    model = fit(table.where("turn is not null"),
                Gru.fresh(voc.frequency, voc.heads, st.width, st.hidden), shards, st)
    rows = log_likelihood(table.drop("turn", "shard", "h", "rare"), model)
    rare = table.select("uid", F.explode("rare").alias("r")).select("uid", "r.word", "r.n")
    c = F.coalesce("c", F.lit(0))
    extra = (rare.join(counts, "word", "left").groupBy("uid").agg(
        F.sum(F.col("n") * F.log10(c + 0.5)).alias("logs"),
        F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more")))
    zero, none = F.lit(0), F.lit(0.0)
    return rows.join(extra, "uid", "left").select(
        F.col("id").alias(id_col), "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(voc.tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("logs", none)).alias("base_score"),
        (F.col("model") + F.col("share") + F.coalesce("logs", none)).alias("score"))
