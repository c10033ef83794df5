"""Best-fit packing of tokenised documents under several capacities."""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqlake.llm.shared import schema, store

GROUP = 4096  # pieces packed together
# How a vocabulary of word ends cuts a text, for characters below U+0300, which no
# normal form changes: contractions, runs of letters, digits, runs of other marks.
_LETTERS = "".join(c for c in map(chr, range(0x300)) if unicodedata.category(c)[0] == "L")
_NUMBERS = "".join(c for c in map(chr, range(0x300)) if unicodedata.category(c)[0] == "N")
_WORD = (
    rf"'(?:[stmdSTMD]|[rR][eE]|[vV][eE]|[lL][lL])|[{_LETTERS}]+|[{_NUMBERS}]|[^\t-\r \x85\xa0{_LETTERS}{_NUMBERS}]+"
)
# beyond them (one capital letter whose small form is longer, special tokens): the whole stretch between blanks
_HARD = r"[^\0-\u012f\u0131-\u02ff]|<\|"
WORD, HARD = re.compile(_WORD), re.compile(_HARD)
WORD_OR_HARD = re.compile(rf"[^\t-\r ]*(?:{_HARD})[^\t-\r ]*|{_WORD}")
KEPT_CHARS = 1 << 23  # characters of distinct words whose ids a Python worker remembers


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(maxsize=1)
def _ids_by_word(path: str):
    """Coder of a list of texts for the vocabulary of word ends, with the same ids as coding each text whole.

    It drops white space and codes every word by itself, so each distinct word is coded
    once and looked up after that, also by later tasks of the same worker. What is
    remembered is bounded.
    """
    tokenizer = _tokenizer(path)
    model, cut = tokenizer.model, tokenizer.pre_tokenizer.pre_tokenize_str
    known: dict[str, bytes] = {}
    held = 0

    def ids(word):
        if HARD.search(word):
            return tokenizer.encode(word, add_special_tokens=False).ids
        low = word.lower()
        if not (low.isascii() and low.isprintable()):
            low = cut(low)[0][0]  # its bytes as the model writes them
        return [token.id for token in model.tokenize(low)]

    def code(texts):
        nonlocal held
        if held > KEPT_CHARS:
            known.clear()
            held = 0
        split = [(WORD_OR_HARD if HARD.search(text) else WORD).findall(text) for text in texts]
        for word in set().union(*split).difference(known):
            known[word] = array("I", ids(word)).tobytes()
            held += len(word)
        return (np.frombuffer(b"".join(map(known.__getitem__, words)), np.uintc) for words in split)

    return code


def _ids_by_text(path: str):
    tokenizer = _tokenizer(path)

    def code(texts):
        return (np.asarray(one.ids, "<u4") for one in tokenizer.encode_batch(texts, add_special_tokens=False))

    return code


def pieces(
    docs: DataFrame, tokenizer_path: str, max_tokens: int = 2048, end_id: int = 0, by_word: bool = False
) -> DataFrame:
    """Cut each document's ids, ``end_id`` last, into pieces of at most ``max_tokens``.

    Returns (doc_id, piece, start, length, ids_crc32). Null text is empty and gives the
    one id ``end_id``. The path of the vocabulary must be readable on every executor.
    ``by_word`` codes each distinct word once; set it only for the vocabulary of word
    ends, whose cuts it knows, and where the ids are the same.
    """

    def run(batches):
        code = (_ids_by_word if by_word else _ids_by_text)(tokenizer_path)
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, 64):  # ids of a few documents at a time
                texts = [text or "" for text in batch.column("text").slice(at, 64).to_pylist()]
                for number, one in enumerate(code(texts), at):
                    ids = np.append(one, np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), max_tokens)):
                        cut = ids[start : start + max_tokens]
                        rows.append((number, k, start, len(cut), zlib.crc32(cut.tobytes())))
            made = np.array(rows, np.int64).reshape(-1, 5).T
            # ids stay Arrow columns: as numbers beside a null they would be rounded
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(made[0])), pa.array(made[1].astype(np.int32)), *map(pa.array, made[2:])],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, schema(f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint")
    )


def best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece, in decreasing order of length.

    A piece needs (tokens, 1 document, tokens squared) of each bin's capacities. Among the
    bins that have room in every one, it goes where the weighted norm of what is left
    afterwards, in shares of the capacities, is least; ties go to the older bin. It opens a
    bin if none has room.
    """
    n = len(lengths)
    need = np.stack([lengths, np.ones(n), lengths.astype(float) ** 2], axis=1) / capacity
    left = np.ones((max(n, 1), 3))
    used = np.zeros(max(n, 1), np.int64)
    open_bins = np.zeros(0, np.int64)
    bins, offsets, made = np.zeros(n, np.int64), np.zeros(n, np.int64), 0
    smallest = lengths.min() / capacity[0] if n else 0
    for i in np.argsort(-lengths, kind="stable"):
        after = left[open_bins] - need[i]
        fits = np.flatnonzero((after > -1e-12).all(axis=1))
        if len(fits):
            rest = after[fits]
            bin_ = open_bins[fits[int(np.argmin((rest * rest) @ weights))]]
        else:
            bin_, made = made, made + 1
            open_bins = np.append(open_bins, bin_)
        bins[i], offsets[i] = bin_, used[bin_]
        used[bin_] += lengths[i]
        left[bin_] -= need[i]
        if left[bin_, 0] < smallest - 1e-12 or left[bin_, 1] < need[i, 1] - 1e-12:
            open_bins = open_bins[open_bins != bin_]
    return bins, offsets


def pack(
    cut: DataFrame,
    max_tokens: int = 2048,
    max_docs: int = 2048,
    max_cost: int = 2048 * 2048,
    weights: tuple[float, float, float] = (1.0, 1e-6, 1e-6),
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces with a ``length`` of at most ``max_tokens``.

    Capacities of a sequence: tokens, documents (pieces) and attention cost (the sum of
    squared lengths). A piece that alone exceeds ``max_cost`` still gets a sequence of its
    own. Pieces are dealt by hash into groups of about ``GROUP``, each packed by itself in
    one task, so the work grows with the number of pieces; a group leaves only its last
    few sequences unfilled. Other columns are kept.
    """
    total = cut.count()
    groups = max(1, -(-total // GROUP))
    capacity = np.array([max_tokens, max_docs, max_cost], float)
    out = schema("sequence_id bigint, offset bigint")
    kept = cut.drop("sequence_id", "offset")
    for field in reversed(kept.schema.fields):
        out.fields.insert(0, field)
        out.names.insert(0, field.name)
    names = kept.columns

    def run(key, part):
        part = part.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32")])
        bins, offsets = best_fit(part.column("length").to_numpy(), capacity, np.asarray(weights))
        placed = [pa.array(bins + (key[0].as_py() << 24)), pa.array(offsets)]
        return pa.Table.from_arrays([*(part.column(c) for c in names), *placed], names=[*names, "sequence_id", "offset"])

    # the row's number takes equal rows apart
    number = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "length", F.monotonically_increasing_id()), F.lit(groups))
    return kept.withColumn("_group", number).groupBy("_group").applyInArrow(run, out)


def pack_documents(docs: DataFrame, tokenizer_path: str, by_word: bool = False, **capacities) -> DataFrame:
    """``pieces`` and ``pack`` in one: one row a piece with its place."""
    return pack(store(pieces(docs, tokenizer_path, by_word=by_word)), **capacities)


def packing_digest(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """All documents with the vocabulary of word ends, which drops white space."""
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(docs, tokenizer_path, by_word=True)
