"""Token ids as flat binary files with 64-bit document offsets.

Per part of the corpus, in ascending order of ids, there are in one folder: `<part>.ids`, the token
ids as little-endian unsigned integers of 2 or 4 bytes; `<part>.docs`, the document ids as 64-bit
integers; `<part>.offsets`, for each document the ids of all documents before it in the whole
corpus, as unsigned 64-bit integers, and one more for the end. The index, a small table, names the
files of each part in order, with its base, counts, and how many of its first documents have no id.
"""

from __future__ import annotations

import io
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelflow.llm.common import as_texts, listed, staged, text_blocks
from parcelflow.session import new_scratch

END_ID = 1
#: Stands for a missing document id in the order of parts: before all others.
NO_ID = -(2**63)
#: Words that a Python worker remembers the ids of.
LEXICON = 1_000_000
#: Pieces encoded alone: with an apostrophe, the start of a special token, or beyond printable ASCII and Latin-1's letters.
_ODD = r"'|<\||[^\x21-\x7e\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]"
#: What stands alone inside a piece: a run of marks, a digit.
_ALONE = r"([!-/:-@\[-`{-~]+|[0-9])"

INDEX = "part int, ids string, docs string, null_ids long, documents long, tokens long"


def _gather(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of pool that begin at starts, one behind the other."""
    before = np.cumsum(lengths) - lengths
    return pool[np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))]


def _sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of values between each two offsets."""
    upto = np.r_[0, np.cumsum(values)]
    return upto[offsets[1:]] - upto[offsets[:-1]]


class Encoder:
    """Ids of whole texts, all from the tokenizers library.

    Only for tokenizers in lower case that drop white space, never look across it, part letters,
    digits and marks, and end each word with a token of its own kind; then a text's ids are those
    of its pieces between white space, and a piece's are those of its runs of letters, single
    digits and runs of marks. Distinct pieces are taken apart as Arrow columns, distinct words
    looked up; new words are encoded together, parted by spaces, and cut behind their last tokens.
    """

    def __init__(self, path: str, kind: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind = Tokenizer.from_file(path), kind
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.starts, self.lengths = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.pool = np.zeros(0, self.kind)

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.kind)

    def _words(self, words: list[str]) -> np.ndarray:
        """Numbers of words, new ones learnt. The empty word has number 0 and no ids."""
        new = [w for w in words if w and w not in self.numbers]
        lengths, pools = [self.lengths], [self.pool]
        for at in range(0, len(new), 4096):
            some = new[at : at + 4096]
            ids = self._ids(" ".join(some))
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(some):
                raise ValueError("this tokenizer doesn't end each word with a token of its own kind")
            first = len(self.numbers) + 1
            self.numbers.update(zip(some, range(first, first + len(some)), strict=True))
            lengths.append(np.diff(np.r_[0, cuts]))
            pools.append(ids[: cuts[-1]])
        self.lengths, self.pool = np.concatenate(lengths), np.concatenate(pools)
        self.starts = np.cumsum(self.lengths) - self.lengths
        return np.array([self.numbers[w] if w else 0 for w in words], np.int64)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, lengths) of distinct pieces."""
        odd = pc.match_substring_regex(pieces, _ODD)
        spaced = pc.replace_substring_regex(pc.if_else(odd, "", pieces), _ALONE, r" \1 ")
        words, offsets = listed(pc.ascii_split_whitespace(pc.utf8_lower(spaced)))
        coded = words.dictionary_encode()
        numbers = self._words(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        per_word = self.lengths[numbers]
        lengths = _sums(per_word, offsets)
        ids = _gather(self.pool, self.starts[numbers], per_word)
        alone = np.flatnonzero(odd.to_numpy(zero_copy_only=False))
        if len(alone):
            more = [self._ids(x) for x in pieces.take(pa.array(alone)).to_pylist()]
            lengths[alone] = [len(x) for x in more]
            order = np.full(len(lengths), -1)
            order[alone] = np.arange(len(alone))
            # Pieces taken alone have no ids yet, so theirs go behind all others.
            starts = np.cumsum(np.where(order < 0, lengths, 0)) - np.where(order < 0, lengths, 0)
            starts[alone] = len(ids) + np.cumsum(lengths[alone]) - lengths[alone]
            return np.concatenate([ids, *more]), starts, lengths
        return ids, np.cumsum(lengths) - lengths, lengths

    def encode(self, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For blocks of texts: the ids of all, each with the end id, and where each text begins and the last ends."""
        for block in text_blocks(texts):
            if len(self.numbers) > LEXICON:
                self.forget()
            pieces, offsets = listed(pc.ascii_split_whitespace(block))
            coded = pieces.dictionary_encode()
            held, starts, lengths = self._pieces(coded.dictionary)
            which = coded.indices.to_numpy()
            ids = _gather(held, starts[which], lengths[which])
            counts = _sums(lengths[which], offsets) + 1
            bounds = np.r_[0, np.cumsum(counts)]
            whole = np.full(bounds[-1], END_ID, self.kind)
            inside = np.ones(bounds[-1], bool)
            inside[bounds[1:] - 1] = False
            whole[inside] = ids
            yield whole, bounds


@lru_cache(maxsize=1)
def _encoder(path: str, kind: str) -> Encoder:
    """Kept between the tasks of one Python worker."""
    return Encoder(path, kind)


def id_type(tokenizer_path: str) -> str:
    """Two bytes where all ids and the end id fit in, else four."""
    from tokenizers import Tokenizer

    size = max(Tokenizer.from_file(tokenizer_path).get_vocab(with_added_tokens=True).values()) + 1
    return "<u2" if max(size, END_ID + 1) <= 1 << 16 else "<u4"


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri else re.sub("^file:/*", "file:///", uri) if uri.startswith("file:") else "file://" + uri)


def _save(folder: str, name: str, data: bytes | memoryview) -> None:
    """Write under a name of the attempt; only names that the index takes up are ever read."""
    files, root = _open(folder)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/{name}") as out:
        out.write(data)


def _map(folder: str, name: str, kind: str) -> np.ndarray:
    """A file as an array: memory-mapped where the folder is a local or mounted path."""
    files, path = _open(f"{folder}/{name}")
    if isinstance(files, pafs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with files.open_input_file(path) as source:
        return np.frombuffer(source.read(), kind)


def _a_task_each(index: DataFrame, parts: int) -> DataFrame:
    """One task per part; a hash would put several into one, and the adaptive planner joins small ones."""
    return index.repartitionById(parts, F.col("part"))


def write_corpus(
    docs: DataFrame, tokenizer_path: str, folder: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, str]:
    """Encode every whole text, write the files, give (index, id type).

    Documents are in ascending order of their ids over all parts, null ids first, repeated ids side
    by side. A null or empty text is its end id only. The tokenizer's file must be at its path on
    every executor. An empty table gives an index without rows. Ids travel compressed, not texts.
    """
    kind = id_type(tokenizer_path)
    size = np.dtype(kind).itemsize
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text"))

    # Bounds of the parts come from the ids alone, so no text is encoded for a sample.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / parts for i in range(1, parts)]
    known = F.coalesce("id", F.lit(NO_ID))
    bounds = np.array(slim.select(F.percentile_approx(known, shares, 10 * parts)).first()[0] or [] if shares else [], np.int64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer, row = _encoder(tokenizer_path, kind), zstandard.ZstdCompressor(level=1), 0
        for batch in batches:
            ids = batch.column("id").fill_null(NO_ID).to_numpy()
            # A hot id is a bound several times; its rows are dealt over all parts that may hold it.
            first, last = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
            part = first + (row + np.arange(len(ids))) % (last - first + 1)
            row += len(ids)
            at = 0
            for whole, ends in encoder.encode(as_texts(batch.column("text"))):
                raw, size, n = memoryview(whole.tobytes()), whole.itemsize, len(ends) - 1
                cuts = (ends * size).tolist()
                packed = [packer.compress(raw[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[at : at + n].astype(np.int32)), batch.column(0).slice(at, n), pa.array(packed, pa.binary())],
                    ["part", "id", "packed"],
                )
                at += n

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, name, unpacker = TaskContext.get().partitionId(), uuid.uuid4().hex, zstandard.ZstdDecompressor()
        files, root = _open(folder)
        files.create_dir(root, recursive=True)
        ids, sizes, nulls, tokens = io.BytesIO(), io.BytesIO(), 0, 0
        with files.open_output_stream(f"{root}/{name}.ids") as out:
            for batch in batches:
                nulls += batch.column("id").null_count
                ids.write(batch.column("id").fill_null(0).to_numpy(zero_copy_only=False).astype("<i8").tobytes())
                raw = [unpacker.decompress(p) for p in batch.column("packed").to_pylist()]
                out.write(b"".join(raw))
                lengths = np.array([len(r) // size for r in raw], "<u8")
                sizes.write(lengths.tobytes())
                tokens += int(lengths.sum())
        if not (count := len(ids.getvalue()) // 8):
            files.delete_file(f"{root}/{name}.ids")
            return
        _save(folder, f"{name}.docs", ids.getvalue())
        _save(folder, f"{name}.sizes", sizes.getvalue())
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([part], pa.int32()), "ids": [f"{name}.ids"], "docs": [f"{name}.docs"], "null_ids": [nulls], "documents": [count], "tokens": [tokens]}
        )

    encoded = slim.mapInArrow(encode, "part int, id long, packed binary")
    ordered = encoded.repartitionById(parts, F.col("part")).sortWithinPartitions("id").select("id", "packed")
    written = staged(ordered.mapInArrow(write, INDEX), "token-parts")
    # One row per part, however large the parts are.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = written.withColumn("base", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)))
    based = _a_task_each(based, parts)

    def offset(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = []
            for row in batch.to_pylist():
                names.append(f"{uuid.uuid4().hex}.offsets")
                ends = np.cumsum(_map(folder, row["docs"].replace(".docs", ".sizes"), "<u8"), dtype=np.uint64)
                _save(folder, names[-1], (np.r_[np.zeros(1, np.uint64), ends] + np.uint64(row["base"])).astype("<u8").tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.string())], [*batch.schema.names, "offsets"])

    index = staged(based.mapInArrow(offset, INDEX + ", base long, offsets string"), "token-index")
    return index, kind


def read_corpus(index: DataFrame, folder: str, kind: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) per document, from the files alone.

    ids_crc32 is that of the ids as little-endian unsigned 32-bit integers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets = _map(folder, row["ids"], kind), _map(folder, row["offsets"], "<u8")
                docs, base = _map(folder, row["docs"], "<i8"), row["base"]
                for at in range(0, len(docs), 4096):
                    bounds = offsets[at : at + 4097].astype(np.int64)
                    named = np.arange(at, at + len(bounds) - 1) < row["null_ids"]
                    sums = [zlib.crc32(ids[a - base : b - base].astype("<u4").tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(docs[at : at + 4096]), pa.int64(), mask=named), pa.array(bounds[:-1]), pa.array(np.diff(bounds)), pa.array(sums, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = (index.agg(F.max("part")).first()[0] or 0) + 1
    return _a_task_each(index, parts).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, **columns) -> DataFrame:
    """Write the corpus to a new folder in the shared scratch space and read it back."""
    folder = new_scratch(docs.sparkSession, "tokens")
    index, kind = write_corpus(docs, tokenizer_path, folder, **columns)
    return read_corpus(index, folder, kind)
