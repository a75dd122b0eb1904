"""Token ids in compressed block files: a static range asymmetric numeral system over shared tables.

``write_token_store`` tokenises whole texts, appends an end id to each document
and writes the ids in ascending document order. Counts of all ids give one
frequency table, stored beside the blocks and used by all of them. A block holds
whole documents and is independent of the others: ``LANES`` interleaved coders
share one stream of 32-bit words, so one step codes that many ids. The lane
states are stored at the start and at every ``CHECKPOINT`` ids, so a reader can
start at any checkpoint, and a checksum covers the block.

The format is three Parquet tables under one folder, so that Spark's commit
protocol covers lost executors and any store that Spark reaches can hold them:
``blocks`` (shard, block, ids, documents and their lengths, states, words,
checksum), ``index`` (the first id of each block) and ``table`` (id, frequency).

Null text is empty and yields the end id alone. Null ids of documents sort
first. Rows with one document id are ordered by a hash of their text; rows equal
in both are interchangeable. Extra columns are not read. An empty table gives no
block. A text longer than a block makes a block of its own.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barlake.llm.text import column_bytes, release_memory, slices, small_batches
from barlake.session import scratch_dir

SCALE_BITS = 18
LOW = 1 << 31
LANES = 2048
BLOCK = 1 << 19
CHECKPOINT = 1 << 18
PIECES_KEPT = 200_000
PIECE_BYTES = 1 << 22
ENCODED_AT_ONCE = 1_000
JOINED = 500
BATCH_BYTES = 1 << 21

# The character that byte-level vocabularies write for a byte: itself if it can be seen, else one from 256 on. Blanks and line ends stay here.
WRITTEN = np.arange(256, dtype="<u4")
WRITTEN[[*range(33), *range(127, 161), 173]] = 256 + np.arange(68)
WRITTEN[[ord(" "), ord("\n")]] = ord(" "), ord("\n")


# ---------------------------------------------------------------- tokenising


class PieceEncoder:
    """Ids of whole texts, each distinct piece between blanks encoded once while it is remembered.

    A byte-level tokenizer that splits before every blank followed by a
    character encodes those pieces independently; the same holds before a line
    end between two characters. Full stops and commas after a letter are split
    off by it too. Texts for which this is not so (runs of white
    space, added tokens, another kind of tokenizer) are encoded as a whole.
    Pieces are told apart and looked up in Arrow. New ones are encoded together,
    as one text of them: each begins with the only id in it that stands for a
    blank or a line end, which tells the ids of one from those of the next. The
    library takes a run of letters as one word, so new pieces that are nothing
    else but for a line end come to the same model as words already, as the
    vocabulary writes them.
    """

    # White space beside a blank or a line end, or at the ends of the text.
    _unsafe = r"[ \n][\s\p{Z}\x{85}\x{1c}-\x{1f}]|[\s\p{Z}\x{85}\x{1c}-\x{1f}]\n|[ \n]$|^\n"

    # Letters in every version of Unicode that a library may know: Latin, Greek, Cyrillic, kana, Han and Hangul.
    _word = (r"^\n?[A-Za-z\x{AA}\x{B5}\x{BA}\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}\x{391}-\x{3A1}\x{3A3}-\x{3CE}\x{400}-\x{481}"
             r"\x{3041}-\x{3096}\x{30A1}-\x{30FA}\x{4E00}-\x{9FA5}\x{AC00}-\x{D7A3}]+$")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        rules = json.loads(self.tokenizer.to_str())
        split = rules.get("pre_tokenizer") or {}
        self.by_piece = (rules.get("normalizer") is None and rules.get("post_processor") is None
                         and split.get("type") == "ByteLevel" and split.get("use_regex", False)
                         and not split.get("add_prefix_space", True) and not rules.get("truncation"))
        self.added = [t["content"] for t in rules.get("added_tokens", [])]
        vocabulary = self.tokenizer.get_vocab()
        self.dtype = np.dtype("<u2") if len(vocabulary) <= 1 << 16 else np.dtype("<u4")
        self.opens = np.zeros(max(vocabulary.values(), default=-1) + 1, bool)
        # a blank and a line end, as byte-level vocabularies write them
        self.opens[[at for token, at in vocabulary.items() if token[:1] in ("\u0120", "\u010a")]] = True
        self.stop, self.pause = (x[0] for x in self.whole([".", ","])) if self.by_piece else (0, 0)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.forget()

    def forget(self) -> None:
        """Known pieces (without the blank before them and the mark after them; a line end stays), their ids in ``flat``."""
        self.known = pa.array([], pa.large_string())
        self.flat, self.starts, self.sizes = np.empty(0, self.dtype), np.empty(0, np.int64), np.empty(0, np.int64)
        self.used = np.empty(0, np.int64)

    def whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of each text, encoded some at a time: what the library returns is many times as large as the ids."""
        out: list[list[int]] = []
        for at in range(0, len(texts), ENCODED_AT_ONCE):
            out += [e.ids for e in self.tokenizer.encode_batch_fast(texts[at : at + ENCODED_AT_ONCE], add_special_tokens=False)]
        return out

    def keep(self) -> None:
        """If too many pieces are known, forget all but the half that was used most, and age the counts."""
        if len(self.known) <= PIECES_KEPT and self.known.nbytes <= PIECE_BYTES:
            return
        places = np.argsort(-self.used, kind="stable")[: PIECES_KEPT // 2]
        lengths = pc.binary_length(self.known).to_numpy()[places]
        places = places[np.cumsum(lengths) <= PIECE_BYTES // 2]
        self.known = self.known.take(pa.array(places))
        self.flat = self.flat[spans(self.starts[places], self.sizes[places])]
        self.sizes, self.used = self.sizes[places], self.used[places] // 2
        self.starts = np.cumsum(self.sizes) - self.sizes

    def together(self, pieces: list[str], words: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(ids of distinct pieces in order, how many each has), of which no text is made longer than ``JOINED``."""
        ids, sizes = [np.empty(0, self.dtype)], [np.empty(0, np.int64)]
        for at in range(0, len(pieces), JOINED):
            some = pieces[at : at + JOINED]
            if words:
                found = self.ids(self.words, as_words(some))
            else:
                found = self.ids(self.tokenizer, "".join(map(spaced, some)))
            first = np.flatnonzero(self.opens[found])
            if len(first) != len(some) or (len(first) and first[0]):  # a tokenizer that writes its vocabulary in another way
                each = self.whole(list(map(spaced, some)))
                sizes.append(np.fromiter(map(len, each), np.int64, len(each)))
                found = np.array([i for x in each for i in x], np.int64)
            else:
                sizes.append(np.diff(first, append=len(found)))
            ids.append(found.astype(self.dtype))
        return np.concatenate(ids), np.concatenate(sizes)

    @staticmethod
    def ids(tokenizer, text: str) -> np.ndarray:
        return np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)

    def find(self, pieces: pa.Array) -> np.ndarray:
        """Places of pieces among the known ones, those met for the first time encoded and added."""
        cores = pieces.dictionary_encode()
        place = pc.index_in(cores.dictionary, value_set=self.known)
        fresh = pc.is_null(place)
        new = cores.dictionary.filter(fresh)
        if len(new):
            alone = pc.match_substring_regex(new, self._word).to_numpy(zero_copy_only=False)
            order = np.argsort(~alone, kind="stable")
            new, n_words = new.take(pa.array(order)), int(alone.sum())
            texts = strings(new)
            flat, sizes = (np.concatenate(x) for x in zip(self.together(texts[:n_words], True), self.together(texts[n_words:])))
            found = place.fill_null(0).to_numpy().copy()
            found[np.flatnonzero(fresh.to_numpy(zero_copy_only=False))[order]] = len(self.known) + np.arange(len(new))
            self.known = pa.concat_arrays([self.known, new])
            self.starts = np.concatenate([self.starts, len(self.flat) + np.cumsum(sizes) - sizes])
            self.sizes = np.concatenate([self.sizes, sizes])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int64)])
            self.flat = np.concatenate([self.flat, flat])
        else:
            found = place.to_numpy()
        return found[cores.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, how many each has)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        safe = np.zeros(len(texts), bool)
        if self.by_piece:
            odd = pc.match_substring_regex(texts, self._unsafe)
            for token in self.added:
                odd = pc.or_(odd, pc.match_substring(texts, token))
            safe = ~odd.to_numpy(zero_copy_only=False)
        out: list[np.ndarray] = [np.empty(0, self.dtype)] * len(texts)
        others = np.flatnonzero(~safe)
        for at, ids in zip(others, self.whole([texts[int(at)].as_py() for at in others])):
            out[at] = np.array(ids, self.dtype)
        chosen = np.flatnonzero(safe)
        if len(chosen):
            ids, ends = self.pieced(texts if len(chosen) == len(texts) else texts.take(pa.array(chosen)))
            self.keep()
            if len(chosen) == len(texts):
                return ids, np.diff(ends)
            for k, at in enumerate(chosen):
                out[at] = ids[ends[k] : ends[k + 1]]
        return np.concatenate([np.empty(0, self.dtype), *out]), np.array([len(x) for x in out], np.int64)

    def pieced(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of texts that may be cut, where those of each begin, and their end)."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        bounds = lists.offsets.to_numpy()
        bounds, pieces = bounds - bounds[0], lists.flatten()
        # the first piece of a text has no blank before it
        heads = self.whole(strings(pieces.take(pa.array(bounds[:-1]))))
        head_sizes = np.array([len(h) for h in heads], np.int64)
        coded = pieces.dictionary_encode()
        distinct, which = coded.dictionary, coded.indices.to_numpy()
        del lists, pieces, coded
        # only an empty head is an empty piece
        distinct = pc.if_else(pc.equal(distinct, ""), "a", distinct)
        marked = pc.match_substring_regex(distinct, r"\p{L}[.,]$")
        place = self.find(pc.if_else(marked, pc.utf8_slice_codeunits(distinct, 0, -1), distinct))
        mark = np.where(pc.ends_with(distinct, ",").to_numpy(zero_copy_only=False), self.pause, self.stop)
        cut = marked.to_numpy(zero_copy_only=False)
        uses = np.bincount(which, minlength=len(place))
        np.add.at(self.used, place, uses)
        starts, sizes = self.starts[place][which], (self.sizes[place] + cut)[which]
        sizes[bounds[:-1]] = head_sizes
        starts[bounds[:-1]] = len(self.flat) + np.cumsum(head_sizes) - head_sizes
        # one more at the end, since a piece with a mark takes an id beyond its own
        flat = np.concatenate([self.flat, np.array([i for h in heads for i in h] + [0], self.dtype)])
        ids = flat[spans(starts, sizes)]
        last = np.cumsum(sizes)
        ended = cut[which]
        ended[bounds[:-1]] = False
        ids[last[ended] - 1] = mark[which[ended]]
        return ids, np.concatenate(([0], last))[bounds]


def strings(column: pa.Array) -> list[str]:
    """The strings of a column without nulls, made at once: ``to_pylist`` goes by way of an Arrow scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


def spaced(piece: str) -> str:
    """A piece as it stands in a text."""
    return piece if piece[:1] == "\n" else " " + piece


def as_words(pieces: list[str]) -> str:
    """Pieces of letters as byte-level vocabularies write them with the blank or line end before them, and a blank after each word."""
    text = " ".join(pieces)
    if not text.isascii():
        text = WRITTEN[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-32-le")
    return ("\u0120" + text.replace(" ", " \u0120")).replace("\u0120\n", "\u010a ")


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places start, start + 1, ... of all spans, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


_encoders: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder per task and file. The driver keeps none, since it would be sent with each task."""
    if path not in _encoders:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _encoders[path] = PieceEncoder(path)
    return _encoders[path]


TOKEN_SCHEMA = "doc_id long, tie long, row long, ids binary, counts binary"


def tokenised(path: str, end_id: int):
    """The ids of each document with the end id, and per task one row with the counts of all its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_memory()
        enc = encoder(path)
        end = np.array([end_id], enc.dtype)
        counts = np.zeros(max(enc.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        row = TaskContext.get().partitionId() << 40
        try:
            for batch in batches:
                texts = batch.column("text")
                _, bounds = column_bytes(texts)
                for first, last in slices(bounds, BATCH_BYTES):
                    n = last - first
                    ids, sizes = enc.encode(texts.slice(first, n))
                    ends = np.cumsum(sizes)
                    ids = np.insert(ids, ends, end)
                    np.add(counts, np.bincount(ids, minlength=len(counts)), out=counts)
                    cuts = np.concatenate(([0], ends + np.arange(1, n + 1))) * enc.dtype.itemsize
                    packed = pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(cuts), pa.py_buffer(ids)])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("doc_id").slice(first, n), batch.column("tie").slice(first, n),
                         pa.array(np.arange(row, row + n)), packed.cast(pa.binary()), pa.nulls(n, pa.binary())],
                        names=["doc_id", "tie", "row", "ids", "counts"])
                    row += n
                    del ids, packed, cuts
                    release_memory(collect=False)
            nothing = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nothing, nothing, nothing, pa.nulls(1, pa.binary()), pa.array([counts.tobytes()], pa.binary())],
                names=["doc_id", "tie", "row", "ids", "counts"])
        finally:  # the worker lives on beside its executor
            _encoders.clear()
            del enc
            release_memory()

    return run


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column("counts"):
            counts = np.frombuffer(x.as_buffer(), np.int64)
            total = counts.copy() if total is None else total + counts
    if total is not None:
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["id", "n"])


# ------------------------------------------------------------- entropy coder


def scaled_frequencies(counts: np.ndarray, bits: int = SCALE_BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least 1 for every id that occurs."""
    total, room = int(counts.sum()), 1 << bits
    if not total:
        return np.zeros(len(counts), np.uint64)
    if np.count_nonzero(counts) > room:
        raise ValueError("more distinct ids than the table has room for")
    freq = np.where(counts > 0, np.maximum(1, np.floor(counts * (room / total))), 0).astype(np.int64)
    spare = room - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    while spare:
        for at in order:
            if not freq[at]:
                break
            step = spare if spare > 0 else -min(-spare, int(freq[at]) - 1)
            freq[at] += step
            spare -= step
            if not spare:
                break
    return freq.astype(np.uint64)


def encode_block(ids: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(states at the checkpoints, word position of each, words) from which ``decode_block`` gives ``ids``."""
    below = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
    f, c = freq[ids], below[ids]
    shift, limit = np.uint64(32), np.uint64(SCALE_BITS)
    top = f << np.uint64(31 - SCALE_BITS + 32)
    state = np.full(LANES, LOW, np.uint64)
    steps = -(-len(ids) // LANES)
    words: list[np.ndarray] = []
    marks: list[np.ndarray] = []
    for step in range(steps - 1, -1, -1):
        at = slice(step * LANES, min((step + 1) * LANES, len(ids)))
        part, fs = state[: at.stop - at.start], f[at]
        full = part >= top[at]
        words.append(part[full].astype(np.uint32))
        part = np.where(full, part >> shift, part)
        whole = part // fs
        state[: at.stop - at.start] = (whole << limit) + (part - whole * fs) + c[at]
        if step * LANES % CHECKPOINT == 0:
            marks.append(state.copy())
    words.reverse()
    marks.reverse()
    ends = np.concatenate(([0], np.cumsum([len(w) for w in words]))).astype(np.int64)
    positions = ends[: steps][:: CHECKPOINT // LANES]
    return (np.array(marks, np.uint64).reshape(-1, LANES), positions,
            np.concatenate(words) if words else np.empty(0, np.uint32))


class Decoder:
    """Reads blocks written under one frequency table."""

    def __init__(self, freq: np.ndarray):
        symbols = np.repeat(np.arange(len(freq), dtype=np.uint64), freq.astype(np.int64))
        below = np.concatenate(([0], np.cumsum(freq)[:-1])).astype(np.uint64)
        inside = np.arange(len(symbols), dtype=np.uint64) - below[symbols]
        # one number per slot, so that a step looks up once: id, frequency less 1, place among the slots of the id
        self.slots = symbols << np.uint64(2 * SCALE_BITS) | (freq[symbols] - np.uint64(1)) << np.uint64(SCALE_BITS) | inside

    def decode(self, states: np.ndarray, positions: np.ndarray, words: np.ndarray, n_ids: int,
               checkpoint: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids from a checkpoint on, to the end of the block or to ``stop``."""
        first, stop = checkpoint * CHECKPOINT, n_ids if stop is None else min(stop, n_ids)
        out = np.empty(max(0, stop - first), np.uint32)
        if not len(out):
            return out
        state, at = states[checkpoint].copy(), int(positions[checkpoint])
        mask, limit, shift, one = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32), np.uint64(1)
        for base in range(first, stop, LANES):
            size = min(LANES, n_ids - base)
            part = state[:size]
            slot = self.slots[(part & mask).view(np.int64)]
            keep = min(size, stop - base)
            out[base - first : base - first + keep] = slot[:keep] >> (limit + limit)
            part = ((slot >> limit & mask) + one) * (part >> limit) + (slot & mask)
            low = np.flatnonzero(part < LOW)
            part[low] = (part[low] << shift) | words[at : at + len(low)]
            at += len(low)
            state[:size] = part
        return out


BLOCK_SCHEMA = ("shard int, block int, n_ids long, doc_ids array<long>, lengths array<long>, states binary, "
                "positions binary, words binary, crc32 long")


def _blocks(freq: np.ndarray, dtype: str):
    """Consecutive documents, as they come, in coded blocks of about ``BLOCK`` ids."""
    width = np.dtype(dtype).itemsize

    def coded(shard: int, number: int, docs: list, parts: list[bytes]) -> pa.RecordBatch:
        lengths = [len(p) // width for p in parts]
        states, positions, words = (x.tobytes() for x in encode_block(np.frombuffer(b"".join(parts), dtype), freq))
        check = zlib.crc32(words, zlib.crc32(positions, zlib.crc32(states)))
        return pa.RecordBatch.from_pydict({
            "shard": pa.array([shard], pa.int32()), "block": pa.array([number], pa.int32()),
            "n_ids": pa.array([sum(lengths)], pa.int64()), "doc_ids": pa.array([docs], pa.list_(pa.int64())),
            "lengths": pa.array([lengths], pa.list_(pa.int64())), "states": pa.array([states], pa.binary()),
            "positions": pa.array([positions], pa.binary()), "words": pa.array([words], pa.binary()),
            "crc32": pa.array([check], pa.int64())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        docs: list = []
        parts: list[bytes] = []
        size = 0
        for batch in batches:
            for doc, ids in zip(batch.column("doc_id").to_pylist(), batch.column("ids")):
                ids = ids.as_py()
                n = len(ids) // width
                if size and size + n > BLOCK:
                    yield coded(shard, block, docs, parts)
                    release_memory(collect=False)
                    block, docs, parts, size = block + 1, [], [], 0
                docs.append(doc)
                parts.append(ids)
                size += n
        if parts:
            yield coded(shard, block, docs, parts)
        release_memory()

    return run


def write_token_store(docs: DataFrame, folder: str, tokenizer: str, end_id: int = 0) -> None:
    """Tokenise ``docs`` (doc_id, text) and write the store under ``folder``.

    Ids are staged in the shared scratch folder, since the frequency table needs
    the counts of all of them; then one shuffle puts them in order. The order of
    the stage breaks ties, so repeated rows spread over ranges as others do. The
    table has one entry per id of the vocabulary, which bounds what the driver
    and the tasks hold of it.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("tie"),
                       F.col("text").cast("string").alias("text"))
    staged = scratch_dir(spark, "tokens")
    small_batches(spark)
    (rows.mapInArrow(tokenised(tokenizer, end_id), TOKEN_SCHEMA).write.option("compression", "zstd").parquet(staged))
    tokens = spark.read.schema(TOKEN_SCHEMA).parquet(staged)
    summed = (tokens.filter("counts is not null").select("counts").mapInArrow(_tally, "id long, n long")
              .groupBy("id").agg(F.sum("n").alias("n")).collect())
    counts = np.zeros(max([end_id, *(r["id"] for r in summed)]) + 1, np.int64)
    for r in summed:
        counts[r["id"]] = r["n"]
    freq = scaled_frequencies(counts)
    table = [(int(i), int(freq[i])) for i in np.flatnonzero(freq)]
    spark.createDataFrame(table, "id long, freq long").coalesce(1).write.mode("overwrite").parquet(f"{folder}/table")
    order = ("doc_id", "tie", "row")
    (tokens.filter("counts is null").select(*order, "ids").repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "ids")
     .mapInArrow(_blocks(freq, PieceEncoder(tokenizer).dtype.str), BLOCK_SCHEMA)
     .write.mode("overwrite").option("compression", "uncompressed").parquet(f"{folder}/blocks"))
    block_starts(spark, folder).write.mode("overwrite").parquet(f"{folder}/index")


def block_starts(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, block, start): prefix sums within each shard, and over the totals of the shards."""
    sizes = spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks").select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(shards, "shard")
            .select("shard", "block", (F.col("base") + F.col("inside")).alias("start")))


def read_frequencies(spark: SparkSession, folder: str) -> np.ndarray:
    rows = spark.read.schema("id long, freq long").parquet(f"{folder}/table").collect()
    freq = np.zeros(max((r["id"] for r in rows), default=-1) + 1, np.uint64)
    for r in rows:
        freq[r["id"]] = r["freq"]
    return freq


def block_arrays(row) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(states, positions, words) of a stored block whose checksum holds."""
    states, positions, words = row["states"], row["positions"], row["words"]
    if zlib.crc32(words, zlib.crc32(positions, zlib.crc32(states))) != row["crc32"]:
        raise ValueError(f"block {row['shard']}/{row['block']} is damaged")
    return (np.frombuffer(states, np.uint64).reshape(-1, LANES), np.frombuffer(positions, np.int64),
            np.frombuffer(words, np.uint32))


def read_token_store(spark: SparkSession, folder: str, keep_ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every stored document, decoded from the blocks."""
    freq = read_frequencies(spark, folder)
    columns = ("shard", "block", "n_ids", "states", "positions", "words", "crc32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(freq)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: batch.column(c)[at].as_py() for c in columns}
                ids = decoder.decode(*block_arrays(row), row["n_ids"])
                docs, lengths = batch.column("doc_ids")[at].values, batch.column("lengths")[at].values
                ends = np.cumsum(lengths.to_numpy())
                starts = ends - lengths.to_numpy()
                pieces = [ids[a:b].astype("<u4") for a, b in zip(starts, ends)]
                n = len(pieces)
                out = {"shard": pa.array([row["shard"]] * n, pa.int32()), "block": pa.array([row["block"]] * n, pa.int32()),
                       "doc_id": docs, "inside": pa.array(starts, pa.int64()), "n_tokens": lengths,
                       "ids_crc32": pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64())}
                if keep_ids:
                    out["ids"] = pa.array(pieces, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)
        release_memory()

    schema = "shard int, block int, doc_id long, inside long, n_tokens long, ids_crc32 long"
    decoded = (spark.read.schema(BLOCK_SCHEMA).parquet(f"{folder}/blocks")
               .mapInArrow(run, schema + ", ids array<long>" * keep_ids))
    starts = spark.read.schema("shard int, block int, start long").parquet(f"{folder}/index")
    return decoded.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * keep_ids)
