"""Byte-level BPE by a global shuffle of distinct words.

Texts are cut into pre-tokens by the pattern of the public rank files. Each chunk of documents keeps its pre-tokens
as positions into its own list of distinct words; those lists go, bucketed by the word's hash, to a shuffle that
encodes each distinct word of the whole corpus once. The ids come back to the chunk, where the positions put them in
order. Decoding looks every id up in the token-byte table. What is shuffled is pre-aggregated and packed: a word
crosses once for each chunk, however often it stands there.
"""

from __future__ import annotations

import base64
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from tideframe.llm.common import frugal, give_back, pack_ints, pack_strings, pack, partitions, ragged, unpack, unpack_ints, unpack_strings

#: The pattern of the public rank files, and the code points of \s in it.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]

#: Distinct words that a task remembers the ids of; beyond it starts anew, so that its memory doesn't grow with the corpus.
MEMORY = 1_000_000

_SPACE, _LETTER, _NUMBER, _OTHER, _NEW = range(5)
_KIND = np.full(0x110000, _NEW, np.uint8)
_KIND[WHITE] = _SPACE


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file: a line for each token, base64 of its bytes and its id."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def _kinds(codes: np.ndarray) -> np.ndarray:
    kinds = _KIND[codes]
    if (kinds == _NEW).any():
        for c in np.unique(codes[kinds == _NEW]).tolist():
            _KIND[c] = _LETTER if regex.match(r"\p{L}", chr(c)) else _NUMBER if regex.match(r"\p{N}", chr(c)) else _OTHER
        kinds = _KIND[codes]
    return kinds


def token_starts(codes: np.ndarray, doc_starts: np.ndarray) -> np.ndarray:
    """Where the matches of PATTERN start in texts that stand end to end; doc_starts marks each text's first place.

    A run of one kind is a token, with these exceptions: a space before a run belongs to it; white space before a run
    gives its last character away; a lone apostrophe takes the letters of a contraction along.
    """
    n = len(codes)
    kinds = _kinds(codes)
    starts = doc_starts.copy()
    starts[1:] |= kinds[1:] != kinds[:-1]
    out = starts.copy()
    after = np.flatnonzero(starts[1:] & ~doc_starts[1:] & (kinds[:-1] == _SPACE)) + 1
    out[after - 1] = True
    spaced = codes[after - 1] == 0x20
    out[after[spaced]] = False
    i = np.flatnonzero(starts & (codes == 0x27))
    i = i[(i + 1 < n) & (doc_starts[i] | (codes[i - 1] != 0x20))]
    i = i[starts[i + 1] & ~doc_starts[i + 1] & (kinds[i + 1] == _LETTER)]
    first = codes[i + 1]
    i2 = np.minimum(i + 2, n - 1)
    second = np.where((i + 2 < n) & ~doc_starts[i2], codes[i2], 0)
    size = np.where(np.isin(first, [*map(ord, "stmd")]), 1, 0)
    for a, b in ("re", "ve", "ll"):
        size[(first == ord(a)) & (second == ord(b))] = 2
    i, size = i[size > 0], size[size > 0]
    out[i + 1] = False
    rest = i + 1 + size
    out[rest[rest < n]] = True
    return out


def pre_tokens(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """All pre-tokens of the texts in order, and how many each text has."""
    whole = "".join(texts)
    sizes = np.array([*map(len, texts)], np.int64)
    ends = np.cumsum(sizes)
    if not whole:
        return [], np.zeros(len(texts), np.int64)
    codes = np.frombuffer(whole.encode("utf-32-le"), "<u4")
    firsts = np.zeros(len(codes), bool)
    firsts[(ends - sizes)[sizes > 0]] = True
    at = np.flatnonzero(token_starts(codes, firsts))
    bounds = at.tolist()
    tokens = [whole[s:e] for s, e in zip(bounds, [*bounds[1:], len(whole)])]
    return tokens, np.searchsorted(at, ends) - np.searchsorted(at, ends - sizes)


_PIECES: dict = {}


def _piece_encoder(key: str, table):
    """The merge function for one rank table, built once for each worker process."""
    if key not in _PIECES:
        _PIECES.clear()
        _PIECES[key] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table.value, special_tokens={})._core_bpe.encode_single_piece
    return _PIECES[key]


def _chunked(buckets: int, chunk_chars: int, words: bool):
    """Chunks of documents as rows: their distinct words by bucket, or their positions. A chunk is known by its place and
    a digest of its texts, so that words never meet the positions of other texts, should df not come twice alike."""
    schema = pa.schema([("bucket", pa.int32()), ("chunk", pa.int64()), ("ids", pa.list_(pa.int64())), ("counts", pa.binary()), ("data", pa.binary())])

    def rows(place: int, ids: list, texts: list[str]) -> pa.RecordBatch:
        digest = xxhash.xxh64(seed=place)
        for text in texts:
            digest.update(f"{len(text)} ")
            digest.update(text)
        chunk = digest.intdigest() - (1 << 63)
        tokens, counts = pre_tokens(texts)
        seen = dict.fromkeys(tokens, 0)
        by_bucket = defaultdict(list)
        for word in seen:
            raw = word.encode()
            by_bucket[zlib.crc32(raw) % buckets].append((raw, word))
        code, out = 0, []
        for b in sorted(by_bucket):
            own = sorted(by_bucket[b])
            for _, word in own:
                seen[word] = code
                code += 1
            if words:
                out.append({"bucket": b, "chunk": chunk, "data": pack_strings([raw for raw, _ in own])})
        if words:
            return pa.RecordBatch.from_pylist(out, schema)
        codes = np.fromiter(map(seen.__getitem__, tokens), np.uint32, len(tokens))
        return pa.RecordBatch.from_pylist([{"bucket": -1, "chunk": chunk, "ids": ids, "counts": pack_ints(counts), "data": pack_ints(codes)}], schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for i, text in zip(batch.column(0), batch.column(1)):
                ids.append(i.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= chunk_chars:
                    yield rows(place, ids, texts)
                    place, ids, texts, size = place + 1, [], [], 0
        if ids:
            yield rows(place, ids, texts)

    return run


def encode(df: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = 2_000_000, buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens long, ids binary (little-endian unsigned 32-bit) for each row of df.

    A null text counts as empty and has no ids; repeated rows and null ids are kept as they come; other columns of df
    are not read. An empty df gives no rows. A chunk holds about chunk_chars characters, more only for one longer text.
    """
    spark = df.sparkSession
    buckets = buckets or max(32, partitions(spark))
    key, table = uuid.uuid4().hex, spark.sparkContext.broadcast(ranks)
    texts = df.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    schema = "bucket int, chunk long, ids array<long>, counts binary, data binary"
    words = texts.mapInArrow(frugal(_chunked(buckets, chunk_chars, words=True)), schema)
    positions = texts.mapInArrow(frugal(_chunked(buckets, chunk_chars, words=False)), schema).select("chunk", "ids", "counts", "data")

    def encode_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = _piece_encoder(key, table)
        known: dict[bytes, list[int]] = {}
        for batch in batches:
            out = []
            for data in batch.column("data"):
                words = unpack_strings(data.as_py())
                for word in words:
                    if word not in known:
                        known[word] = piece(word)
                ids = [known[word] for word in words]
                flat = np.array([x for one in ids for x in one], "<u4")
                out.append(pack(np.array([len(ids), *map(len, ids)], "<u4").tobytes() + flat.tobytes()))
                if len(known) > MEMORY:
                    known.clear()
            yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("bucket"), pa.array(out, pa.binary())], names=["chunk", "bucket", "data"])

    encoded = words.select("bucket", "chunk", "data").repartition(buckets, "bucket").mapInArrow(frugal(encode_words), "chunk long, bucket int, data binary")

    def reassemble(left: pa.Table, right: pa.Table) -> pa.Table:
        flats, sizes = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
        for row in sorted(right.select(["bucket", "data"]).to_pylist(), key=lambda r: r["bucket"]):
            raw = np.frombuffer(unpack(row["data"]), "<u4")
            sizes.append(raw[1 : raw[0] + 1])
            flats.append(raw[raw[0] + 1 :])
        flat, size = np.concatenate(flats), np.concatenate(sizes).astype(np.int64)
        at = np.cumsum(size) - size
        ids, counts, blobs = [], [], []
        for row in left.to_pylist():
            codes, n = unpack_ints(row["data"]), unpack_ints(row["counts"]).astype(np.int64)
            if codes.size and codes.max() >= len(size):
                raise ValueError("the input came in another order the second time; write it to a table first")
            ends = np.cumsum(n)
            ids += row["ids"]
            for e, k in zip(ends.tolist(), n.tolist()):
                own = codes[e - k : e]
                got = ragged(flat, at[own], size[own])
                counts.append(len(got))
                blobs.append(got.tobytes())
        del flats, flat, sizes, left, right
        give_back()
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(blobs, pa.binary())})

    return positions.groupBy("chunk").cogroup(encoded.groupBy("chunk")).applyInArrow(reassemble, "doc_id long, n_tokens long, ids binary")


def decode(df: DataFrame, ranks: dict[bytes, int], ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """df with the bytes that its ids stand for, by the token-byte table (as many rows as there are ranks).

    A null list of ids decodes to null. An id without a rank is an error.
    """
    tokens = [token for token, _ in sorted(ranks.items(), key=lambda x: x[1])]
    if sorted(ranks.values()) != [*range(len(ranks))]:
        raise ValueError("ranks must run from 0 without gaps")
    table = df.sparkSession.sparkContext.broadcast(tokens)
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = table.value
        size = np.array([*map(len, tokens)], np.int64)
        at, flat = np.cumsum(size) - size, np.frombuffer(b"".join(tokens), np.uint8)
        for batch in batches:
            out = []
            for x in batch.column(names.index(ids_col)):
                if x.is_valid:
                    ids = np.frombuffer(x.as_buffer(), "<u4")
                    out.append(ragged(flat, at[ids], size[ids]).tobytes())
                else:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*names, out_col])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(frugal(run), f"{schema}, `{out_col}` binary")


def digests(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """Of every text: the number of its ids, their digest and that of the bytes they decode to."""
    ranks = read_ranks(path)
    both = decode(encode(docs, ranks), ranks)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
