"""Token ids as directly addressable codes: any token is read without decoding those before it.

An id is split into chunks of eight bits.  Level 0 holds the lowest chunk of every id, and a bitmap
says which ids go on; level 1 holds the next chunk of those only, and so on.  A rank directory holds
the number of set bits before every 512th position, so the place of an id in the next level is one
lookup and a count of at most 512 bits.

File format: a Parquet table with one row per segment of whole documents,

    part int, seq int           place of the segment; ascending, in ascending doc_id order
    offset long                 ids of the part before this segment
    doc_ids array<..>           documents, ascending (nulls first)
    sizes array<long>           ids of each, the end id included
    n_ids long                  ids of the segment
    levels array<struct<chunks binary, more binary, ranks binary>>
                                bytes; continuation bits, lowest first; little-endian uint32

A segment ends with the document that brings it to ``segment_ids``; a longer document is a segment
of its own.  Documents are dealt by ranges of doc_id, so no task sees more than its range, and the
ids before a part come from one sum per part.

Cases: a null or empty text is the end id alone.  Repeated rows and equal doc_ids stay, next to
each other (equal ids are ordered by text).  A null doc_id sorts first.  Extra columns are ignored.
An empty table writes an empty table and reads back no rows.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from array import array
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslane.plans.durable import checkpoint_dir

CHUNK_BITS = 8
RANK_EVERY = 512
SEGMENT_IDS = 1 << 18
#: Words whose ids a task remembers at once; beyond this the memory starts anew.
REMEMBERED_WORDS = 300_000
#: Marks that the splitting pattern keeps in one run after a letter or digit.
_MARKS = ".,!?;:*$%&#|"
#: Fixed values of byte-level vocabularies: printable bytes stand for themselves, the others are
#: numbered on from 256.
_PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARS = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
#: Of these bytes, those of plain words and the space before them.
_IN_PLAIN = [b for b in _BYTE_CHARS if b == 32 or b >= 128]
#: Characters of texts whose words are looked up together.
CHARS_AT_ONCE = 1 << 23
#: Characters that are split into words at once; longer texts are taken apart.
CHARS_SPLIT = 1 << 20
#: Bytes of an Arrow batch of texts.
BATCH_BYTES = 1 << 22
#: Distinct words that one call of the model gets.
_WORDS_AT_ONCE = 1 << 15
#: A word with the space or line feed before it, if any: letters of one piece, and a run of marks as another.
_PLAIN = f"^[ \n]?[A-Za-zÀ-ÖØ-öø-ÿ]+[{re.escape(_MARKS)}]*$"
_MARK_RUN = re.compile(f"[{re.escape(_MARKS)}]+")


class Codes:
    """The levels of one segment."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def encode(cls, ids: np.ndarray) -> Codes:
        levels, rest = [], ids.astype(np.uint32)
        while True:
            higher = rest >> CHUNK_BITS
            more = higher > 0
            ones = np.add.reduceat(more, np.arange(0, max(1, len(more)), RANK_EVERY), dtype=np.uint32) if len(more) else np.zeros(0, np.uint32)
            ranks = np.concatenate([[0], np.cumsum(ones)[:-1]]).astype("<u4") if len(ones) else np.zeros(0, "<u4")
            levels.append(((rest & 0xFF).astype(np.uint8), np.packbits(more, bitorder="little"), ranks))
            if not more.any():
                return cls(levels)
            rest = higher[more]

    @classmethod
    def of_row(cls, levels: list) -> Codes:
        kinds = (("chunks", np.uint8), ("more", np.uint8), ("ranks", "<u4"))
        return cls([tuple(np.frombuffer(x[c], dtype=k) for c, k in kinds) for x in levels])

    def rows(self) -> list[dict[str, bytes]]:
        return [dict(zip(("chunks", "more", "ranks"), (x.tobytes() for x in level), strict=True)) for level in self.levels]

    def decode(self) -> np.ndarray:
        """All ids of the segment."""
        ids = np.zeros(0, dtype=np.uint32)
        for chunks, more, _ in reversed(self.levels):
            out = chunks.astype(np.uint32)
            flag = np.unpackbits(more, count=len(chunks), bitorder="little").astype(bool)
            if flag.any():
                out[flag] |= ids << CHUNK_BITS
            ids = out
        return ids

    def access(self, at: int) -> int:
        """One id, from one byte and one rank per level."""
        found = 0
        for depth, (chunks, more, ranks) in enumerate(self.levels):
            found |= int(chunks[at]) << (CHUNK_BITS * depth)
            if not more[at >> 3] >> (at & 7) & 1:
                break
            block = at // RANK_EVERY
            bits = more[block * RANK_EVERY >> 3 : at >> 3]
            below = int(more[at >> 3]) & ((1 << (at & 7)) - 1)
            at = int(ranks[block]) + int(np.bitwise_count(bits).sum()) + below.bit_count()
        return found


class _Plain:
    """Packed ids of many plain words at once, from the model without the splitting pattern."""

    def __init__(self, library, kind: np.dtype):
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.kind = kind
        vocabulary = library.get_vocab()
        # An id stands for as many bytes as its entry has characters.
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        self.sizes[list(vocabulary.values())] = list(map(len, vocabulary))
        self.pieces = type(library)(library.model)
        self.pieces.pre_tokenizer = CharDelimiterSplit("\t")

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, and how many each has."""
        # Tabs end the pieces; a line feed before a word is a piece of its own.
        joined = _MARK_RUN.sub("\t\\g<0>", "\t".join(words.to_pylist()))
        coded = joined.encode().decode("latin-1").replace("\n", _BYTE_CHARS[10] + "\t")
        for byte in _IN_PLAIN:
            coded = coded.replace(chr(byte), _BYTE_CHARS[byte])
        ids = np.array(self.pieces.encode_batch_fast([coded], add_special_tokens=False)[0].ids, dtype=self.kind)
        ends = np.cumsum(pc.binary_length(words).to_numpy())
        return ids, np.diff(np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1, prepend=0)


class _Words(dict):
    """Packed ids by word as it stands after a space; ``\\n`` and a word stand for a new line's first word.

    A word that is not there yet goes to the library's model.  A final run of marks after a letter
    or digit has ids of its own, as the splitting pattern separates it.
    """

    def __init__(self, library, kind: np.dtype, feed: bytes):
        super().__init__()
        self.library, self.kind, self.feed = library, kind, feed
        self.marks: dict[str, bytes] = {}

    def packed(self, text: str) -> bytes:
        return array(self.kind.char, self.library.encode(text, add_special_tokens=False).ids).tobytes()

    def learn(self, text: str) -> bytes:
        """Ids of a space, or none, and a word."""
        if text.strip(" ").isalpha():
            # One run of letters is one piece for the model, which sees its bytes as characters.
            pieces = self.library.model.tokenize(text.encode().decode("latin-1").translate(_BYTE_CHARS))
            return array(self.kind.char, [p.id for p in pieces]).tobytes()
        return self.packed(text)

    def __missing__(self, word: str) -> bytes:
        base = word.rstrip(_MARKS)
        if base != word and base and base[-1].isalnum():
            run = word[len(base) :]
            if run not in self.marks:
                self.marks[run] = self.packed(run)
            found = self[base] + self.marks[run]
        elif word[:1] == "\n":
            found = self.feed + self.learn(word[1:])
        else:
            found = self.learn(" " + word)
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        self[word] = found
        return found


class Encoder:
    """A tokenizer of the tokenizers library; one that splits at spaces first remembers words.

    A byte-level pre-tokenizer that neither adds a space nor merges across words gives a word and
    the space before it the same ids wherever they stand.  Texts with other white space than single
    spaces and line feeds between words, or with a special token's start, go to the library whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        # A task has one core.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.library = Tokenizer.from_file(path)
        told = json.loads(self.library.to_str())
        split = told.get("pre_tokenizer") or {}
        self.kind = np.dtype("<u2") if self.library.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.by_word = (
            told.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space", True)
            and split.get("use_regex", False)
            and all(t["content"].startswith("<|") for t in told.get("added_tokens", []))
            and all(_BYTE_CHARS.get(b, chr(b)) in told["model"]["vocab"] for b in range(256))
        )
        self.words = _Words(self.library, self.kind, b"")
        if self.by_word:
            self.words.feed, self.plain = self.words.packed("\n"), _Plain(self.library, self.kind)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text, as ``encode(text, add_special_tokens=False)`` gives them."""
        if not self.by_word:
            found = self.library.encode_batch_fast(texts, add_special_tokens=False)
            return [np.array(x.ids, dtype=self.kind).tobytes() for x in found]
        out, held, size = [], [], 0
        for i, text in enumerate(texts):
            parts = list(_cut(text))
            if "<|" in text or not all(_even(p, at > 0) for at, p in enumerate(parts)):
                held.append((i, None))
                continue
            for at, part in enumerate(parts):
                held.append((i, part))
                size += len(part)
                if size >= CHARS_AT_ONCE:
                    out += self._parts(held, texts)
                    held, size = [], 0
        out += self._parts(held, texts)
        found = [[] for _ in texts]
        for i, ids in out:
            found[i].append(ids)
        return [b"".join(x) for x in found]

    def _parts(self, held: list[tuple[int, str | None]], texts: list[str]) -> list[tuple[int, bytes]]:
        """Ids of parts of texts, or of the whole text for None."""
        whole = [(i, self.words.packed(texts[i])) for i, part in held if part is None]
        held = [x for x in held if x[1]]
        if not held:
            return whole
        coded, offsets = [], []
        for run in _runs([part for _, part in held]):
            # A tab before each space and line feed, except where a part begins with it.
            marked = [part[0] + part[1:].replace(" ", "\t ").replace("\n", "\t\n") for part in run]
            split = pc.split_pattern(pa.array(marked, pa.large_string()), "\t")
            coded.append(split.flatten().dictionary_encode())
            offsets.append(split.offsets.to_numpy())
        coded = pa.chunked_array(coded).unify_dictionaries().chunks
        ids, sizes = self._ids(coded[0].dictionary)
        # Each word's ids, gathered in the order of the texts.
        begins, out = (np.cumsum(sizes) - sizes).astype(np.int32), []
        for words, bounds in zip(coded, offsets, strict=True):
            places = words.indices.to_numpy()
            n = sizes[places]
            ends = np.concatenate([[0], np.cumsum(n)])
            source = np.repeat(begins[places] - ends[:-1].astype(np.int32), n)
            source += np.arange(len(source), dtype=np.int32)
            gathered = ids[source].tobytes()
            cuts = (ends[bounds] * self.kind.itemsize).tolist()
            out += [gathered[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return whole + [(i, packed) for (i, _), packed in zip(held, out, strict=True)]

    def _ids(self, used: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these words one after the other, and how many each has."""
        ids, sizes = [], []
        for first in range(0, len(used), _WORDS_AT_ONCE):
            part = used.slice(first, _WORDS_AT_ONCE)
            is_plain = pc.match_substring_regex(part, _PLAIN)
            plain, n = is_plain.to_numpy(zero_copy_only=False), np.zeros(len(part), dtype=np.int64)
            others = [
                self.words[w[1:]] if w[0] == " " else self.words[w] if w[0] == "\n" else self.words.learn(w)
                for w in part.filter(pc.invert(is_plain)).to_pylist()
            ]
            n[~plain] = [len(x) // self.kind.itemsize for x in others]
            some = np.empty(0, self.kind)
            if plain.any():
                some, n[plain] = self.plain.encode(part.filter(is_plain))
            placed, mine = np.empty(n.sum(), self.kind), np.repeat(plain, n)
            placed[mine] = some
            placed[~mine] = np.frombuffer(b"".join(others), dtype=self.kind)
            ids.append(placed)
            sizes.append(n)
        return np.concatenate(ids), np.concatenate(sizes)


def _runs(parts: list[str]) -> Iterator[list[str]]:
    """Consecutive parts up to CHARS_SPLIT characters, or one part."""
    run, size = [], 0
    for part in parts:
        if run and size + len(part) > CHARS_SPLIT:
            yield run
            run, size = [], 0
        run.append(part)
        size += len(part)
    if run:
        yield run


def _cut(text: str) -> Iterator[str]:
    """A text in parts that begin at a space or a line feed."""
    at, limit = 0, min(CHARS_SPLIT, CHARS_AT_ONCE)
    while len(text) - at > limit:
        end = max(text.rfind(" ", at + 1, at + limit), text.rfind("\n", at + 1, at + limit))
        if end < 0:
            # A longer word: to its end.
            end = min((x for x in (text.find(" ", at + limit), text.find("\n", at + limit)) if x >= 0), default=-1)
        if end < 0:
            break
        yield text[at:end]
        at = end
    yield text[at:]


def _even(part: str, inside: bool) -> bool:
    """Whether a text, or one's part that begins between words, has one space or line feed between words."""
    words = " ".join(part.split())
    if inside:
        return words != "" and " " + words == part.replace("\n", " ")
    return words == part.replace("\n", " ")


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


_LEVEL = pa.list_(pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("ranks", pa.binary())]))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows up to CHARS_AT_ONCE bytes of text, or one row."""
    held, size = [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            end = int(np.searchsorted(ends, before + CHARS_AT_ONCE - size, side="right"))
            if end <= at and held:
                yield pa.Table.from_batches(held)
                held, size = [], 0
                continue
            end = max(at + 1, end)
            held.append(batch.slice(at, end - at))
            size += int(ends[end - 1]) - before
            at = end
    if held:
        yield pa.Table.from_batches(held)


def _writer(tokenizer: str, end_id: int, segment_ids: int):
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, part = encoder(tokenizer), TaskContext.get().partitionId()
        end = np.array([end_id], dtype=tool.kind).tobytes()
        seq = offset = held = 0
        docs, packed = [], []

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(packed), dtype=tool.kind)
            sizes = [len(p) // tool.kind.itemsize for p in packed]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([seq], pa.int32()),
                    pa.array([offset], pa.int64()),
                    pa.array([docs], pa.list_(kind)),
                    pa.array([sizes], pa.list_(pa.int64())),
                    pa.array([len(ids)], pa.int64()),
                    pa.array([Codes.encode(ids).rows()], _LEVEL),
                ],
                names=["part", "seq", "offset", "doc_ids", "sizes", "n_ids", "levels"],
            )

        for rows in _groups(batches):
            kind = rows.column("doc_id").type
            for doc, ids in zip(rows.column("doc_id").to_pylist(), tool.encode(rows.column("text").to_pylist()), strict=True):
                docs.append(doc)
                packed.append(ids + end)
                held += len(packed[-1]) // tool.kind.itemsize
                if held >= segment_ids:
                    yield segment()
                    seq, offset, held, docs, packed = seq + 1, offset + held, 0, [], []
        if docs:
            yield segment()
        # The worker lives on for other stages.
        rows = None
        pa.default_memory_pool().release_unused()

    return segments


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_BYTES for what runs meanwhile, unless the session has a size of its own."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) is not None:
        yield
        return
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name)


def write_codes(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, segment_ids: int = SEGMENT_IDS) -> None:
    """Encode every whole text and write its ids, in ascending doc_id order, to ``path``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"part int, seq int, offset long, doc_ids array<{kind}>, sizes array<long>, n_ids long, "
        "levels array<struct<chunks: binary, more: binary, ranks: binary>>"
    )
    segments = (
        docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(_writer(tokenizer, end_id, segment_ids), schema)
    )
    with _small_batches(docs.sparkSession):
        segments.write.parquet(path)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in ("part", "offset", "sizes", "levels")}
            ids, sizes = Codes.of_row(row["levels"]).decode().astype("<u4"), np.array(row["sizes"], dtype=np.int64)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(sizes), row["part"]), pa.int32()),
                    batch.column("doc_ids").slice(i, 1).flatten(),
                    pa.array(starts + row["offset"], pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["part", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens and ids_crc32."""
    table = spark.read.parquet(path)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per written part.
    parts = (
        table.groupBy("part")
        .agg(F.sum("n_ids").alias("n"))
        .select(F.col("part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    kind = table.schema["doc_ids"].dataType.elementType.simpleString()
    docs = table.select("part", "offset", "doc_ids", "sizes", "levels").mapInArrow(
        _summaries, f"part int, doc_id {kind}, within long, n_tokens long, ids_crc32 long"
    )
    return docs.join(parts, "part").select("doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Write the ids of documents and read back what the files say of each."""
    spark = docs.sparkSession
    path = path or f"{checkpoint_dir(spark)}/token-codes-{uuid.uuid4().hex}"
    write_codes(docs, path, tokenizer, end_id)
    return read_summary(spark, path)
