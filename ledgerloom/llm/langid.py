"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a fixed public vocabulary. Each language has its own
piece probabilities, learned by expectation maximisation; a word's probability is
the sum over all ways to cut it into pieces, computed by the forward algorithm,
and a text's the product over its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm.common import held, named, over_batches, text_of
from ledgerloom.operators.scale import running_cuts
from ledgerloom.session import checkpointed

UNDETERMINED = "und"
SAMPLE_DOCS = 500
ITERATIONS = 2
LONGEST_PIECE = 16
UNKNOWN = 1e-7
SHARED_WEIGHT = 200.0
KNOWN_WORDS = 300_000
#: Texts scored at a time.
BATCH = 512
_SAFE_LENGTH = 32
#: Longer words are learned from in parts of this length, so that a task's arrays stay bounded.
LONGEST_LEARNED = 1 << 16
_PAD = "\0"
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 20
#: Ids fall into 65,536 buckets by the leading bits of their hash.
_BUCKET_SHIFT = 48


class Pieces:
    """The vocabulary's pieces of up to ``LONGEST_PIECE`` characters, found by hash in whole batches of words."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        kept = [
            model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        self.names = sorted(piece for piece in kept if len(piece) <= LONGEST_PIECE)
        self.size = len(self.names)
        self.powers = [np.uint64(pow(int(_BASE), k, 1 << 64)) for k in range(LONGEST_PIECE + 1)]
        hashes = np.array([self._hash(piece) for piece in self.names], dtype=np.uint64)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        self.taken = np.zeros(1 << _SLOTS, dtype=bool)
        self.taken[(hashes * _BASE) >> np.uint64(64 - _SLOTS)] = True

    @staticmethod
    def _hash(piece: str) -> int:
        value = 0
        for letter in piece:
            value = (value * int(_BASE) + ord(letter) + 1) % (1 << 64)
        return value

    def lattice(self, words: list[str]) -> list[np.ndarray]:
        """For words of one length: per piece length, the piece that starts at each place (rows) of each word.

        A number beyond the vocabulary is the unknown character, the one after it no piece.
        """
        length = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        codes = codes.reshape(len(words), length).T.astype(np.uint64) + np.uint64(1)
        prefix = np.zeros((length + 1, len(words)), dtype=np.uint64)
        for at in range(length):
            prefix[at + 1] = prefix[at] * _BASE + codes[at]
        found = []
        for size in range(1, min(length, LONGEST_PIECE) + 1):
            part = prefix[size:] - prefix[:-size] * self.powers[size]
            ids = np.full(part.shape, self.size if size == 1 else self.size + 1, dtype=np.int32)
            maybe = np.nonzero(self.taken[(part * _BASE) >> np.uint64(64 - _SLOTS)])
            wanted = part[maybe]
            at = np.minimum(np.searchsorted(self.hashes, wanted), self.size - 1)
            same = self.hashes[at] == wanted
            ids[maybe[0][same], maybe[1][same]] = self.order[at[same]]
            found.append(ids)
        return found


def pieces_of(path: str) -> Pieces:
    return held(("pieces", path), lambda: Pieces(path))


def _padded(chances: np.ndarray) -> np.ndarray:
    """Piece probabilities with a row for the unknown character and one for no piece."""
    unknown = np.full((1, chances.shape[1]), UNKNOWN)
    return np.concatenate([chances, unknown, np.zeros_like(unknown)])


def forward(lattice: list[np.ndarray], chances: np.ndarray) -> np.ndarray:
    """Log probability of each word in each language: the sum over all its segmentations."""
    length, count = lattice[0].shape
    kinds = chances.shape[1]
    recent = [np.ones((count, kinds))]
    scale = np.zeros((count, kinds))
    for end in range(1, length + 1):
        total = np.zeros((count, kinds))
        for size in range(1, min(end, len(lattice)) + 1):
            total += recent[-size] * chances[lattice[size - 1][end - size]]
        recent.append(total)
        if len(recent) > len(lattice):
            recent.pop(0)
        if length > _SAFE_LENGTH:
            recent = [part / total for part in recent]
            scale += np.log(total)
    return np.log(recent[-1]) + scale


def expected(lattice: list[np.ndarray], chances: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """Expected piece counts per language, of words with one weight per language."""
    length = lattice[0].shape[0]
    kinds = chances.shape[1]
    shape = (length + 1, *weights.shape)
    alpha, beta = np.zeros(shape), np.zeros(shape)
    alpha[0] = beta[length] = 1.0
    for end in range(1, length + 1):
        for width in range(1, min(end, len(lattice)) + 1):
            alpha[end] += alpha[end - width] * chances[lattice[width - 1][end - width]]
    for start in range(length - 1, -1, -1):
        for width in range(1, min(length - start, len(lattice)) + 1):
            beta[start] += beta[start + width] * chances[lattice[width - 1][start]]
    counts = np.zeros((size + 2, kinds))
    share = weights / alpha[length]
    for width, ids in enumerate(lattice, 1):
        for start in range(length - width + 1):
            mass = alpha[start] * chances[ids[start]] * beta[start + width] * share
            for kind in range(kinds):
                counts[:, kind] += np.bincount(ids[start], mass[:, kind], size + 2)
    return counts[:size]


def padded_lattice(own: Pieces, words: list[str]) -> list[np.ndarray]:
    """Lattice of words of any lengths, filled up with a sign of its own number, two beyond the vocabulary."""
    length = max(map(len, words))
    lattice = own.lattice([word.ljust(length, _PAD) for word in words])
    lattice[0][np.arange(length)[:, None] >= np.array([len(word) for word in words])] = own.size + 2
    return lattice


def expected_long(lattice: list[np.ndarray], chances: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    """``expected`` for words of any length: sums are kept as logarithms, so that none runs empty.

    ``chances`` is that of ``expected``; signs that fill words up are certain.
    """
    length, count = lattice[0].shape
    kinds, widest = chances.shape[1], len(lattice)
    chances = np.concatenate([chances, np.ones((1, kinds))])

    def pieces(start: int, width: int) -> np.ndarray:
        return chances[lattice[width - 1][start]]

    ahead, back = np.zeros((length + 1, count, kinds)), np.zeros((length + 1, count, kinds))
    for end in range(1, length + 1):
        near = ahead[end - 1]
        total = sum(
            np.exp(ahead[end - width] - near) * pieces(end - width, width) for width in range(1, min(end, widest) + 1)
        )
        ahead[end] = near + np.log(total)
    for start in range(length - 1, -1, -1):
        near = back[start + 1]
        total = sum(
            np.exp(back[start + width] - near) * pieces(start, width) for width in range(1, min(length - start, widest) + 1)
        )
        back[start] = near + np.log(total)
    counts = np.zeros((size + 3, kinds))
    for start in range(length):
        for width in range(1, min(length - start, widest) + 1):
            ids = lattice[width - 1][start]
            known = np.flatnonzero(ids < size)
            if not len(known):
                continue
            share = np.exp(ahead[start, known] + back[start + width, known] - ahead[length, known])
            mass = share * chances[ids[known]] * weights[known]
            np.add.at(counts, ids[known], mass)
    return counts[:size]


def _long_groups(words: list[str], kinds: int) -> Iterator[list[int]]:
    """Numbers of words of like length (within a factor of two), so many at a time that their arrays stay small."""
    classes: dict[int, list[int]] = {}
    for number, word in enumerate(words):
        classes.setdefault(len(word).bit_length(), []).append(number)
    for bits, numbers in sorted(classes.items()):
        step = max(1, 2_000_000 // ((1 << bits) * kinds))
        for start in range(0, len(numbers), step):
            yield numbers[start : start + step]


def _by_length(words: list[str]) -> dict[int, list[str]]:
    groups: dict[int, list[str]] = {}
    for word in words:
        groups.setdefault(len(word), []).append(word)
    return groups


def words_of(text: str) -> list[str]:
    return text.lower().split()


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _parts(word: str) -> list[str]:
    return [word[at : at + LONGEST_LEARNED] for at in range(0, len(word), LONGEST_LEARNED)]


class Scorer:
    """Word scores of a batch at a time; at most ``KNOWN_WORDS`` words and one batch's are remembered."""

    def __init__(self, pieces: Pieces, chances: np.ndarray) -> None:
        self.pieces, self.chances = pieces, _padded(chances)
        self.known: dict[str, int] = {}
        self.rows = np.zeros((0, chances.shape[1]))

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > KNOWN_WORDS:
            self.known, self.rows = {}, self.rows[:0]
        new = sorted(words - self.known.keys())
        parts = [self.rows]
        for length, group in _by_length(new).items():
            step = max(1, 200_000 // length)
            for start in range(0, len(group), step):
                part = group[start : start + step]
                self.known.update(zip(part, range(len(self.known), len(self.known) + len(part)), strict=True))
                parts.append(forward(self.pieces.lattice(["▁" + word for word in part]), self.chances))
        self.rows = np.concatenate(parts)

    def score(self, texts: list[str]) -> np.ndarray:
        """Log probability of each text in each language."""
        split = [words_of(text) for text in texts]
        missing = set().union(*split)
        if not missing <= self.known.keys():
            self._learn(missing)
        number = self.known.__getitem__
        return np.array([self.rows[list(map(number, words))].sum(axis=0) for words in split])


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: one fifth, by id. A null id is neither held out nor learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def _counted(sample: DataFrame) -> DataFrame:
    schema = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])

    def rows(batch: pa.RecordBatch) -> dict:
        counts: Counter = Counter()
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            counts.update((lang, word) for word in words_of(text))
        return {
            "lang": [key[0] for key in counts], "word": [key[1] for key in counts], "n": list(counts.values())
        }

    return sample.mapInArrow(over_batches(rows, schema), "lang string, word string, n long")


def trained(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text", lang_column: str = "lang",
    sample_docs: int = SAMPLE_DOCS, iterations: int = ITERATIONS,
) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities, from labelled documents that are not held out.

    Of each language the ``sample_docs`` documents with the smallest hash of their
    id are learned from (one at least), whole texts; that bounds the work. Where
    the sample ends is found by counts per hash bucket, and rows are ordered only
    inside the one bucket of a language that holds its end. Words of any length are
    learned from; one over ``LONGEST_LEARNED`` characters counts as parts of that
    length. Every iteration is a
    job over the sample's distinct words; the driver gets one number per piece
    and language. Without labelled documents there are no languages.
    """
    labelled = docs.select(*named(id=id_column, lang=lang_column)).filter(
        F.col("lang").isNotNull() & F.col("id").isNotNull() & ~held_out(F.col("id"))
    )
    hashed = labelled.withColumn("hash", F.xxhash64(F.col("id").cast("string")))
    placed = hashed.withColumn("bucket", F.shiftright("hash", _BUCKET_SHIFT)).withColumn("one", F.lit(1).cast("long"))
    cuts = running_cuts(placed, ["lang"], ["bucket"], ["hash", "id"], "one", {"sample": F.lit(max(1, sample_docs))})
    within = F.coalesce(F.struct("hash", "id") <= F.col("sample_key"), F.lit(True))
    picked = hashed.join(F.broadcast(cuts), "lang", "left").filter(within)
    texts = docs.select(*named(id=id_column, lang=lang_column), text_of(f"`{text_column}`").alias("text"))
    sample = texts.join(F.broadcast(picked.select("id", "lang").distinct()), ["id", "lang"], "left_semi")
    counts = checkpointed(_counted(sample).groupBy("lang", "word").agg(F.sum("n").alias("n")))
    langs = sorted(row[0] for row in labelled.select("lang").distinct().collect())
    pieces = pieces_of(path)
    chances = np.full((pieces.size, len(langs)), 1.0 / pieces.size)
    if not langs:
        return langs, chances
    columns = [F.sum(F.when(F.col("lang") == lang, F.col("n")).otherwise(0)).cast("double") for lang in langs]
    weighted = checkpointed(counts.groupBy("word").agg(F.array(*columns).alias("weights")))
    schema = pa.schema([("piece", pa.int32()), ("lang", pa.int32()), ("mass", pa.float64())])
    for _ in range(iterations):
        shared = docs.sparkSession.sparkContext.broadcast(_padded(chances))

        def rows(batch: pa.RecordBatch, shared=shared) -> dict:
            own = pieces_of(path)
            total = np.zeros((own.size, shared.value.shape[1]))
            weights = dict(zip(batch.column("word").to_pylist(), batch.column("weights").to_pylist(), strict=True))
            for group in _by_length([word for word in weights if len(word) <= _SAFE_LENGTH]).values():
                lattice = own.lattice(["▁" + word for word in group])
                total += expected(lattice, shared.value, np.array([weights[word] for word in group]), own.size)
            long = [
                (part, weight) for word, weight in weights.items() if len(word) > _SAFE_LENGTH for part in _parts("▁" + word)
            ]
            texts = [part for part, _ in long]
            for numbers in _long_groups(texts, total.shape[1]):
                lattice = padded_lattice(own, [texts[number] for number in numbers])
                total += expected_long(lattice, shared.value, np.array([long[number][1] for number in numbers]), own.size)
            piece, lang = np.nonzero(total)
            return {"piece": piece.astype(np.int32), "lang": lang.astype(np.int32), "mass": total[piece, lang]}

        masses = weighted.mapInArrow(over_batches(rows, schema, 20_000, keep=("pieces", path)), "piece int, lang int, mass double")
        counted = np.zeros_like(chances)
        for piece, lang, mass in masses.groupBy("piece", "lang").agg(F.sum("mass")).collect():
            counted[piece, lang] = mass
        shared.destroy()
        pooled = counted.sum(axis=1, keepdims=True) + 0.01
        pooled /= pooled.sum()
        chances = (counted + SHARED_WEIGHT * pooled) / (counted.sum(axis=0) + SHARED_WEIGHT)
    return langs, chances


def decision(text: Column, langs: list[str], chances: np.ndarray, path: str) -> Column:
    """Language and score of a text, as a struct of ``lang_pred`` and ``score``.

    The score is the posterior probability of the language at equal priors. Null
    text, text without a letter, and any text if no language was learned is
    ``und`` with score 0. Ties go to the first language by name. Only the text goes
    to Python; the rest of the row stays where it is.
    """
    shared = SparkSession.getActiveSession().sparkContext.broadcast(chances)
    schema = pa.schema([("lang_pred", pa.string()), ("score", pa.float64())])

    def rows(texts: list[str], scorer: Scorer) -> pa.Array:
        fits = [bool(langs) and has_letter(text) for text in texts]
        logs = scorer.score([text for text, fit in zip(texts, fits, strict=True) if fit]) if any(fits) else []
        best, scores = [], []
        scored = iter(logs)
        for fit in fits:
            if fit:
                log = next(scored)
                top = int(log.argmax())
                best.append(langs[top])
                scores.append(float(1.0 / np.exp(log - log[top]).sum()))
            else:
                best.append(UNDETERMINED)
                scores.append(0.0)
        return pa.StructArray.from_arrays([pa.array(best, schema[0].type), pa.array(scores, schema[1].type)], fields=list(schema))

    @F.arrow_udf("lang_pred string, score double")
    def decided(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(pieces_of(path), shared.value)
        for batch in batches:
            parts = [rows(batch.slice(at, BATCH).to_pylist(), scorer) for at in range(0, len(batch), BATCH)]
            yield pa.concat_arrays(parts) if parts else rows([], scorer)

    return decided(F.coalesce(text.cast("string"), F.lit("")))


def identified(
    docs: DataFrame, langs: list[str], chances: np.ndarray, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``id``, ``lang_pred`` and ``score`` (see ``decision``) of every row's whole text.

    Rows stay where they are; repeated rows each come back. An empty table gives
    no rows. Other columns are ignored.
    """
    decided = decision(F.col(f"`{text_column}`"), langs, chances, path).alias("decision")
    return docs.select(*named(id=id_column), decided).select("id", "decision.*")
