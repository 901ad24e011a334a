"""Encoding of a whole corpus with a public byte-level BPE vocabulary.

One pass counts the corpus' words (the tokenizer's own splits), the commonest
``lexicon_words`` of them get their ids once and are compiled into a minimal
transducer, which every Python worker maps into memory; a second pass splits the
texts, looks words up and merges the unseen ones exactly by the vocabulary's
ranks. The bound on the lexicon is on its size only: every text is encoded
whole, with the same result for any bound.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import os
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orgloom.llm.lexicon import Lexicon, compile_lexicon
from orgloom.session import shared_dir

#: Fixed value: how byte-level BPE splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
TOKENIZERS = os.environ.get("ORGLOOM_TOKENIZERS", "/opt/tokenizers")
#: Words in the lexicon at most: some 3 MB, whatever the corpus' size.
LEXICON_WORDS = 50_000
#: A worker forgets the words it has met beyond this many.
CACHED_WORDS = 200_000

_workers: dict[tuple, tuple] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one word: the lowest-ranked adjacent pair is merged, leftmost first, until none has a rank.

    A heap over the pairs makes it n log n, for words of any length.
    """
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    end = list(range(1, n + 1))  # part that starts at i ends at end[i]
    before, alive = list(range(-1, n - 1)), [True] * n
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue  # one of its parts has been merged since
        right = end[i]
        alive[right] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (left := before[i]) >= 0 and (r := ranks.get(word[left:stop])) is not None:
            heapq.heappush(heap, (r, left, stop))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import regex

    split, counts = regex.compile(SPLIT), Counter()

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"word": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    for batch in batches:
        for text in batch.column(0):
            if text.is_valid:
                counts.update(split.findall(text.as_py()))
        if len(counts) > CACHED_WORDS:
            yield out()
            counts.clear()
    yield out()


def word_counts(documents: DataFrame, text_col: str) -> DataFrame:
    """How often each word of the tokenizer occurs in all texts: ``word, n``; summed in the workers before the shuffle."""
    parts = documents.select(F.col(text_col).cast("string").alias("text")).mapInArrow(_count_words, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(documents: DataFrame, text_col: str, ranks_path: str, lexicon_words: int = LEXICON_WORDS) -> str:
    """Compiles the lexicon into the shared folder, hands it to all executors and returns its name.

    At most ``lexicon_words`` words reach the driver: those met twice or more,
    commonest first, ties by the word.
    """
    ranks = read_ranks(ranks_path)
    top = word_counts(documents, text_col).filter("n > 1 and length(word) <= 64").orderBy(F.desc("n"), "word").limit(lexicon_words)
    block = compile_lexicon({w: merge(w, ranks) for w in (r.word.encode() for r in top.select("word").toLocalIterator())})
    return share_block(documents.sparkSession, block)


def share_block(spark: SparkSession, block: bytes, kind: str = "lexicon") -> str:
    """Writes a block of bytes to the shared folder and lets Spark bring it to every executor; returns the file's name."""
    jvm, name = spark._jvm, f"{kind}-{hashlib.sha256(block).hexdigest()[:24]}.bin"
    at = jvm.org.apache.hadoop.fs.Path(shared_dir(spark), name)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        stream = fs.create(at, True)
        stream.write(bytearray(block))
        stream.close()
    spark.sparkContext.addFile(fs.makeQualified(at).toString())
    return name


def _worker(lexicon_name: str, ranks_name: str) -> tuple:
    key = (lexicon_name, ranks_name)
    if key not in _workers:
        import regex

        _workers.clear()
        _workers[key] = (regex.compile(SPLIT), Lexicon.map_file(SparkFiles.get(lexicon_name)), read_ranks(SparkFiles.get(ranks_name)), {})
    return _workers[key]


def encode_text(text: str, split, lexicon: Lexicon, ranks: dict[bytes, int], known: dict[str, list[int]]) -> list[int]:
    ids: list[int] = []
    for word in split.findall(text):
        found = known.get(word)
        if found is None:
            raw = word.encode("utf-8", "surrogatepass")
            found = lexicon.get(raw)
            if found is None:
                found = merge(raw, ranks)
            if len(known) >= CACHED_WORDS:
                known.clear()
            if len(word) <= 64:
                known[word] = found
        ids += found
    return ids


def encode(documents: DataFrame, id_col: str, text_col: str, ranks_path: str | None = None, lexicon_words: int = LEXICON_WORDS, counts_only: bool = False, carry: list[str] | None = None) -> DataFrame:
    """``id_col``, the ``carry`` columns and ``ids array<int>`` of every row (or ``n_tokens int``, with ``counts_only``).

    Empty and null texts get an empty list (0 tokens); blank texts are encoded
    like any other. Special tokens are neither added nor recognised. Rows are
    neither dropped nor joined: repeated ids stay repeated, a null id stays. An
    empty table gives an empty one. Other columns are ignored. The
    vocabulary is read on the driver and goes to the executors like the lexicon.
    """
    ranks_path = ranks_path or os.path.join(TOKENIZERS, "byte_bpe_50k.tiktoken")
    kept = [id_col, *(carry or [])]
    rows = documents.select(F.col(text_col).cast("string").alias("__text"), *[F.col(c).alias(c) for c in kept])
    name = build_lexicon(documents, text_col, ranks_path, lexicon_words)
    with open(ranks_path, "rb") as f:
        ranks_name = share_block(documents.sparkSession, f.read(), "ranks")
    schema = ", ".join(f"`{c}` {documents.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, lexicon, ranks, known = _worker(name, ranks_name)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                ids = [encode_text(t, split, lexicon, ranks, known) if t else [] for t in part.column(0).to_pylist()]
                values = pa.array([len(x) for x in ids], pa.int32()) if counts_only else pa.array(ids, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], values], names=[*kept, "n_tokens" if counts_only else "ids"])

    return rows.mapInArrow(run, schema + (", n_tokens int" if counts_only else ", ids array<int>"))
