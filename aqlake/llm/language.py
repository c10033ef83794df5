"""Language identification by interpolated Kneser-Ney character models in sorted hash arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aqlake.llm.calibrate import fit_logistic, logistic
from aqlake.llm.shared import fold, schema, store

ORDER = 4
DISCOUNT = 0.75
ALPHABET = 1 << 16  # characters the base distribution spreads over
PIECE = 1 << 21  # about as many entries of a model are in memory at a time
BATCH = 2_000_000  # characters scored at a time


def letters(text: str | None) -> np.ndarray:
    """Code units of the lower-cased text, runs of other characters as one space, spaces around; empty without letters."""
    lowered = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    if not lowered:
        return np.zeros(0, np.uint16)
    units = np.frombuffer(f" {' '.join(lowered)} ".encode("utf-16-le", "surrogatepass"), "<u2")
    return np.concatenate([np.full(ORDER - 2, 32, np.uint16), units])


def grams(units: np.ndarray) -> np.ndarray:
    """Each run of four units as one 64-bit number, the last unit lowest."""
    wide = units.astype(np.uint64)
    n = max(0, len(units) - ORDER + 1)
    out = np.zeros(n, np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | wide[i : i + n]
    return out


def gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): how often each run of four characters occurs in all texts of a language."""

    def run(batches):
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                found = [grams(letters(t)) for t in part["text"]]
                values, counts = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"lang": lang, "gram": values.view(np.int64), "n": counts})

    taught = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("lang", "text")
    counted = taught.mapInPandas(run, schema("lang string, gram bigint, n bigint"))
    return store(counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """(lang, size, gram, kind, value): discounted shares of grams ("a") and rests of contexts ("g").

    The longest grams use their counts, shorter ones in how many different grams they
    end. For size k, value "a" = max(n - D, 0) / n(context), and "g" of a context =
    D x its different continuations / n(context). All counted entries are kept.
    """
    parts = []
    level = counts
    for size in range(ORDER, 0, -1):
        context = F.shiftrightunsigned("gram", 16)
        totals = level.groupBy("lang", context.alias("context")).agg(
            F.sum("n").alias("total"), F.count("*").alias("kinds")
        )
        parts.append(
            level.withColumn("context", context)
            .join(totals, ["lang", "context"])
            .select(
                "lang",
                F.lit(size).alias("size"),
                "gram",
                F.lit("a").alias("kind"),
                (F.greatest(F.col("n") - DISCOUNT, F.lit(0.0)) / F.col("total")).alias("value"),
            )
        )
        parts.append(
            totals.select(
                "lang",
                F.lit(-size).alias("size"),
                F.col("context").alias("gram"),
                F.lit("g").alias("kind"),
                (DISCOUNT * F.col("kinds") / F.col("total")).alias("value"),
            )
        )
        shorter = F.col("gram").bitwiseAND(F.lit((1 << 16 * (size - 1)) - 1))
        level = store(level.groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def _mixed(size: int, gram: np.ndarray) -> np.ndarray:
    """64-bit hash of a gram and its size (negative: a context)."""
    x = gram.astype(np.uint64) + np.uint64(size * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(size: np.ndarray, gram: np.ndarray) -> np.ndarray:
    out = np.zeros(len(gram), np.uint64)
    for k in np.unique(size):
        out[size == k] = _mixed(int(k), gram[size == k].view(np.uint64))
    return out


def _piece_of(hashes: np.ndarray, cuts: int) -> np.ndarray:
    """Which of 2 ** ``cuts`` equal ranges of hashes each is in."""
    return (hashes >> np.uint64(64 - cuts)).astype(np.int64) if cuts else np.zeros(len(hashes), np.int64)


def _sorted(hashes: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(hashes)
    return hashes[order], values[order].astype(np.float32)


def _opened(piece) -> tuple[np.ndarray, np.ndarray]:
    """A piece's arrays; a broadcast one is read from its file and not held on to."""
    if not isinstance(piece, Broadcast):
        return piece
    arrays = piece.value
    if getattr(piece, "_path", None):
        vars(piece).pop("_value", None)
    return arrays


class LanguageModels:
    """For each language sorted arrays of hashes with their values, cut by hash into pieces that are read in turn.

    ``pieces`` holds for each language 2 ** c pieces, arrays or broadcasts of them, in
    order of their hashes. Made from a table, each language is one piece.
    """

    def __init__(self, table: pd.DataFrame | None = None, pieces: dict[str, list] | None = None):
        if pieces is None:
            pieces = {}
            for lang, part in table.groupby("lang"):
                hashes = _hashes(part["size"].to_numpy(), part["gram"].to_numpy().astype(np.int64))
                pieces[lang] = [_sorted(hashes, part["value"].to_numpy())]
        self.langs = sorted(pieces)
        self.pieces = [pieces[lang] for lang in self.langs]
        self.right = 1.0, 0.0  # slope and offset, by the margin
        self.known = 0.0, 30.0  # by the lowest entropy; as good as certain until calibrated

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """(languages, grams): -log2 of each last character's probability."""
        wanted = []  # the different hashes in order, and where each gram's is
        with np.errstate(over="ignore"):
            for size in range(1, ORDER + 1):
                own = gram & np.uint64((1 << 16 * size) - 1)
                for k, key in ((-size, own >> np.uint64(16)), (size, own)):
                    hashes, back = np.unique(_mixed(k, key), return_inverse=True)
                    wanted.append((hashes, back.astype(np.int32), 1.0 if k < 0 else 0.0))
        out = []
        for pieces in self.pieces:
            found = [np.full(len(hashes), missing, np.float32) for hashes, _, missing in wanted]
            for k, piece in enumerate(pieces):
                known, values = _opened(piece)
                if not len(known):
                    continue
                for (hashes, _, _), into in zip(wanted, found):
                    first, end = np.searchsorted(_piece_of(hashes, len(pieces).bit_length() - 1), [k, k + 1])
                    part = hashes[first:end]
                    at = np.minimum(np.searchsorted(known, part), len(known) - 1)
                    into[first:end] = np.where(known[at] == part, values[at], into[first:end])
            p = np.full(len(gram), 1 / ALPHABET)
            for k in range(0, len(wanted), 2):
                p = found[k + 1][wanted[k + 1][1]] + found[k][wanted[k][1]] * p
            out.append(-np.log2(p))
        return np.array(out).reshape(len(self.pieces), len(gram))

    def entropies(self, texts) -> np.ndarray:
        """(texts, languages): bits a character; infinite for texts without letters."""
        out = np.full((len(texts), len(self.langs)), np.inf)
        pending, size = [], 0

        def flush():
            found, back = np.unique(np.concatenate([g for _, g in pending]), return_inverse=True)
            bits = self.bits(found)
            ends = np.cumsum([len(g) for _, g in pending])
            for k in range(len(self.langs)):
                sums = np.add.reduceat(bits[k][back], np.concatenate([[0], ends[:-1]]))
                out[[i for i, _ in pending], k] = sums / np.array([len(g) for _, g in pending])
            pending.clear()

        for i, text in enumerate(texts):
            gram = grams(letters(text))
            if len(gram):
                pending.append((i, gram))
                size += len(gram)
                if size >= BATCH:
                    flush()
                    size = 0
        if pending:
            flush()
        return out

    def predict(self, texts) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language (``und`` without letters), calibrated probability that it is right, entropy."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.full(len(texts), np.inf)
        bits = self.entropies(texts)
        best = bits.argmin(axis=1)
        lowest = bits[np.arange(len(bits)), best]
        lettered = np.isfinite(lowest)
        likely = logistic(np.where(lettered, lowest, 0.0), *self.known) * logistic(_margin(bits), *self.right)
        return [self.langs[b] if k else "und" for b, k in zip(best, lettered)], np.where(lettered, likely, 0.0), lowest

    def calibrate(self, texts, langs) -> None:
        """Fit the two factors of the score on texts that the models have not learnt from.

        Whether a text's language is among the models' at all is judged by its lowest entropy. What a text of
        an unknown language looks like is told by the same texts without the model of their own language. Whether
        the best language is right, if it is among them, is judged by how far the second best is behind.
        """
        if not len(texts) or not self.langs:
            return
        bits = self.entropies(texts)
        lettered = np.isfinite(bits.min(axis=1))
        bits, own = bits[lettered], np.array([self.langs.index(lang) for lang in langs])[lettered]
        if not len(bits):
            return
        right = (bits.argmin(axis=1) == own).astype(int)
        slope, offset = fit_logistic(_margin(bits), right)
        # without a mistake that a margin could tell, the share of right ones is all there is to say
        self.right = (slope, offset) if slope > 0 else (0.0, float(np.log((right.sum() + 1) / (len(right) - right.sum() + 1))))
        if len(self.langs) < 2:
            return
        others = bits.copy()
        others[np.arange(len(bits)), own] = np.inf
        lowest = np.concatenate([bits.min(axis=1), others.min(axis=1)])
        slope, offset = fit_logistic(lowest, np.repeat([1, 0], len(bits)))
        if slope < 0:  # else the languages are too alike for an entropy to tell
            self.known = slope, offset


def _margin(bits: np.ndarray) -> np.ndarray:
    """How far the second best language is behind the best."""
    if bits.shape[1] < 2:
        return np.ones(len(bits))
    two = np.partition(np.where(np.isfinite(bits), bits, 0.0), 1, axis=1)
    return two[:, 1] - two[:, 0]


def _pieces(entries: DataFrame) -> dict[str, list]:
    """Each language's entries as broadcast pieces of about ``PIECE`` of them; the driver holds one piece at a time."""
    entries = store(entries)
    first, cuts, n = {}, {}, 0
    for lang, count in sorted(tuple(r) for r in entries.groupBy("lang").count().collect()):
        first[lang], cuts[lang] = n, (-(-count // PIECE) - 1).bit_length()
        n += 1 << cuts[lang]

    def run(batches):
        for batch in batches:
            for lang, part in batch.groupby("lang"):
                hashes = _hashes(part["size"].to_numpy(), part["gram"].to_numpy())
                piece = first[lang] + _piece_of(hashes, cuts[lang])
                yield pd.DataFrame({"piece": piece, "hash": hashes.view(np.int64), "value": part["value"].to_numpy()})

    hashed = store(entries.mapInPandas(run, schema("piece bigint, hash bigint, value float")), "piece")
    context = entries.sparkSession.sparkContext

    def piece(k: int) -> Broadcast:
        part = hashed.where(F.col("piece") == k).select("hash", "value").toPandas()
        return context.broadcast(_sorted(part["hash"].to_numpy().view(np.uint64), part["value"].to_numpy()))

    return {lang: [piece(first[lang] + k) for k in range(1 << cuts[lang])] for lang in first}


def fit_languages(docs: DataFrame, sample: int = 2000) -> LanguageModels:
    """Models from the rows with text and lang, calibrated on texts that are left out of them.

    A tenth of the different texts, at most ``sample``, are left out: those with the least hashes. A language
    that would lose all its texts keeps them. All copies of a text are on one side. With fewer than ten
    texts none is left out and nothing is calibrated.
    """
    h = F.xxhash64("text", "lang")
    taught = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).select("text", "lang")
    hashes = store(taught.select("lang", h.alias("h")).distinct())
    left_out = F.lit(False)
    if take := min(sample, hashes.count() // 10):
        upto = hashes.orderBy("h").limit(take).agg(F.max("h")).first()[0]
        langs = [r[0] for r in hashes.where(F.col("h") > upto).select("lang").distinct().collect()]
        left_out = (h <= upto) & F.col("lang").isin(langs)
    models = LanguageModels(pieces=_pieces(kneser_ney(gram_counts(taught.where(~left_out)))))
    some = taught.where(left_out).groupBy(h.alias("h")).agg(F.min(F.struct("text", "lang")).alias("row")).select("row.*").toPandas()
    # a language without a single letter in its texts has no model
    some = some[some["lang"].isin(models.langs)]
    models.calibrate(some["text"].tolist(), some["lang"].tolist())
    return models


def identify(docs: DataFrame, models: LanguageModels, min_score: float = 0.5) -> DataFrame:
    """(doc_id, lang_pred, score, rejected), one row per row of ``docs``.

    The language whose model needs the fewest bits a character over the whole text; ties
    go to the first name. ``und`` with score 0 for null text and text without letters. The score
    is the calibrated probability that the language is one of the models' and that it is the right one.
    ``rejected``: no language, or a score below ``min_score``. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            langs, score, _ = models.predict(batch.column("text").to_pylist())
            # ids stay Arrow columns: as numbers beside a null they would be rounded
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(list(langs), pa.string()), pa.array(score), pa.array(score < min_score)],
                names=["doc_id", "lang_pred", "score", "rejected"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, schema(f"doc_id {kind}, lang_pred string, score double, rejected boolean")
    )


def language_digest(docs: DataFrame) -> DataFrame:
    """Language of every document, learnt where crc32(doc_id as text) mod 3 is not 1."""
    models = fit_languages(docs.where(fold(F.col("doc_id"), 3) != 1))
    return identify(docs, models).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )
