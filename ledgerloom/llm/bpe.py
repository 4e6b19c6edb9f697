"""Byte-level BPE by a lazily determinised finite-state transducer.

Greedy merging by rank has one result per text, and a token sequence is that
result exactly if every two neighbouring tokens are (merging their joined bytes
gives the two back). So every prefix of a text has one last token, and reading a
byte only needs the tokens that are still being spelled: for each live start its
spelled bytes, the last token before it, and the tokens not yet emitted. Such a
set is one state of the transducer; states and moves are made when first met.
Tokens common to all live starts are emitted, so lookahead never exceeds the
longest token.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerloom.llm.common import arrow_type, held, named, over_batches, text_of

MAX_STATES = 220_000
MAX_PIECES = 220_000
DECODE_STEP = 65_536
#: Bytes that are no UTF-8 are kept as they are.
KEEP_BYTES = "surrogateescape"
_START = -1
#: Marks that end a word; after letters each is a match of its own unless more marks follow.
_MARKS = frozenset(".,;:!?")


class Recent:
    """The newest entries of a mapping, at most twice ``limit``: a full half pushes out the older half."""

    def __init__(self, limit: int) -> None:
        self.limit, self.new, self.old = limit, {}, {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.new) >= self.limit:
            self.new, self.old = {}, self.new
        self.new[key] = value


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a tiktoken vocabulary file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Transducer:
    """Merges compiled state by state; at most ``max_states`` states and as many cached pieces are held."""

    def __init__(
        self, ranks: dict[bytes, int], pattern: str, max_states: int = MAX_STATES, max_pieces: int = MAX_PIECES
    ) -> None:
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.decimals = {rank: str(rank) for rank in ranks.values()}
        self.prefixes = {token[:end] for token in ranks for end in range(1, len(token))}
        self.max_states, self.max_pieces = max_states, max_pieces
        self.parents: dict[int, tuple[int, int]] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.words = Recent(max_pieces)
        self._restart()

    def _restart(self) -> None:
        """Forget all states but the first; they are made again when met."""
        self.items: list[tuple] = [((b"", _START, ()),)]
        self.numbers = {self.items[0]: 0}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def _halves(self, token: int) -> tuple[int, int]:
        """The two tokens whose merge makes ``token``: what merges of lower rank leave of its bytes."""
        known = self.parents.get(token)
        if known is None:
            raw, ranks = self.tokens[token], self.ranks
            parts = [raw[i : i + 1] for i in range(len(raw))]
            while len(parts) > 2:
                rank, at = min((ranks.get(parts[i] + parts[i + 1], token), i) for i in range(len(parts) - 1))
                if rank >= token:
                    raise ValueError(f"token {token} is not made by merges")
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            known = self.parents[token] = (ranks[parts[0]], ranks[parts[1]])
        return known

    def _fit(self, left: int, right: int) -> bool:
        """Whether merging the joined bytes of two tokens leaves just these two.

        The later merge of the two tokens is undone again and again. If the pieces
        that then meet at the border had a merge that came before the undone one,
        that merge would have crossed the border.
        """
        tokens, ranks, before = self.tokens, self.ranks, 1 << 60
        while True:
            across = ranks.get(tokens[left] + tokens[right])
            if across is not None and across < before:
                return False
            if left > right and len(tokens[left]) > 1:
                before, left = left, self._halves(left)[1]
            elif len(tokens[right]) > 1:
                before, right = right + 1, self._halves(right)[0]
            elif len(tokens[left]) > 1:
                before, left = left, self._halves(left)[1]
            else:
                return True

    def _stands(self, left: int, right: int) -> bool:
        known = self.fits.get((left, right))
        if known is None:
            if len(self.fits) > self.max_pieces:
                self.fits.clear()
            known = self.fits[left, right] = self._fit(left, right)
        return known

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determinise one move: the next state and the tokens that are now certain."""
        letter = bytes([byte])
        live, ended = [], None
        for spelled, last, waiting in self.items[state]:
            longer = spelled + letter
            if ended is None:
                rank = self.ranks.get(longer)
                if rank is not None and (last == _START or self._stands(last, rank)):
                    ended = (b"", rank, (*waiting, rank))
            if longer in self.prefixes:
                live.append((longer, last, waiting))
        if ended is None:
            raise ValueError(f"the vocabulary has no token for byte {byte}")
        live.append(ended)
        shared = 0
        for column in zip(*(waiting for _, _, waiting in live), strict=False):
            if any(token != column[0] for token in column):
                break
            shared += 1
        sure = ended[2][:shared]
        key = tuple([(spelled, last, waiting[shared:]) for spelled, last, waiting in live])
        number = self.numbers.get(key)
        if number is None:
            number = self.numbers[key] = len(self.items)
            self.items.append(key)
        move = self.moves[state << 8 | byte] = (number, sure)
        return move

    def piece(self, text: str) -> tuple[int, ...]:
        """Ids of one match of the split pattern; a match that is itself a token is that token."""
        raw = text.encode()
        whole = self.ranks.get(raw)
        if whole is not None:
            return (whole,)
        if len(self.items) > self.max_states:
            self._restart()
        state, ids, known = 0, (), self.moves.get
        for byte in raw:
            state, sure = known(state << 8 | byte) or self._move(state, byte)
            if sure:
                ids += sure
        return ids + self.items[state][-1][2]

    def matches(self, text: str) -> tuple[int, ...]:
        """Ids of a text's matches."""
        return tuple(chain.from_iterable(map(self.piece, self.split(text))))

    def word(self, word: str) -> tuple[int, ...]:
        """Ids of a space and a word; letters and one mark need no pattern."""
        if word.isalpha():
            return self.piece(" " + word)
        if word[-1] in _MARKS and word[:-1].isalpha():
            return self.piece(" " + word[:-1]) + self.piece(word[-1])
        return self.matches(" " + word)

    def encode(self, text: str) -> list[int]:
        """Ids of a text, word by word.

        Only a match's first character may be a space, so a single space between
        two other characters always starts a match and a text may be cut there. A
        text with other white space next to a space is matched as a whole.
        """
        first, *words = text.split(" ")
        if not first or first[-1].isspace():
            return list(self.matches(text))
        out = list(map(self.words.new.get, words))
        if None in out:
            known = self.words
            for at, found in enumerate(out):
                if found is None:
                    word = words[at]
                    found = known.get(word)
                    if found is None:
                        if not word or word[0].isspace() or word[-1].isspace():
                            return list(self.matches(text))
                        found = self.word(word)
                        if len(word) <= 64:
                            known.put(word, found)
                    out[at] = found
        return list(chain(self.matches(first), *out))


def decode(ids: Iterable[int], tokens: dict[int, bytes]) -> Iterator[bytes]:
    """Token bytes in blocks of bounded size."""
    ids = iter(ids)
    while block := b"".join(map(tokens.__getitem__, islice(ids, DECODE_STEP))):
        yield block


def decode_text(blocks: Iterable[bytes], errors: str = "replace") -> Iterator[str]:
    """Characters of a byte stream; the incremental UTF-8 machine holds back a character cut by a block's end."""
    machine = codecs.getincrementaldecoder("utf-8")(errors)
    for block in blocks:
        yield machine.decode(block)
    yield machine.decode(b"", True)


def encoded(
    docs: DataFrame,
    path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    with_ids: bool = True,
    with_text: bool = False,
    max_states: int = MAX_STATES,
    max_pieces: int = MAX_PIECES,
) -> DataFrame:
    """Ids of every row's whole text, and what they decode to.

    ``path`` names a tiktoken rank file on every machine (it comes with an
    installed package), ``pattern`` the split pattern. Returns ``id``,
    ``n_tokens``, ``ids`` (``with_ids``), ``ids_sha256`` of the decimal ids joined
    by a space, ``decoded`` (``with_text``) and ``decoded_sha256`` of the decoded
    bytes. Null text is empty text: no tokens, the digests of the empty string.
    Rows stay where they are, so skew, ties and repeated rows make no difference;
    repeated rows each come back. Strings of special tokens are ordinary text. An
    empty table gives no rows. Other columns are ignored.

    A Python worker keeps ``max_states`` states and ``max_pieces`` words and token
    pairs for its next texts: some 300 MB by default, less at the price of CPU time.
    """
    narrow = docs.select(*named(id=id_column), text_of(f"`{text_column}`").alias("text"))
    fields: list[tuple[str, pa.DataType, T.DataType]] = [("n_tokens", pa.int64(), T.LongType())]
    if with_ids:
        fields.append(("ids", pa.list_(pa.int32()), T.ArrayType(T.IntegerType())))
    fields.append(("ids_sha256", pa.string(), T.StringType()))
    if with_text:
        fields.append(("decoded", pa.string(), T.StringType()))
    fields.append(("decoded_sha256", pa.string(), T.StringType()))
    schema = pa.schema([("id", arrow_type(narrow, "id")), *[(name, kind) for name, kind, _ in fields]])
    result = T.StructType([narrow.schema["id"], *[T.StructField(name, kind) for name, _, kind in fields]])

    key = ("bpe", path, pattern, max_states, max_pieces)

    def rows(batch: pa.RecordBatch) -> dict:
        transducer = held(key, lambda: Transducer(read_ranks(path), pattern, max_states, max_pieces))
        columns: dict = {"id": batch.column("id"), **{name: [] for name, _, _ in fields}}
        for text in batch.column("text").to_pylist():
            ids = transducer.encode(text)
            decimal = " ".join(map(transducer.decimals.__getitem__, ids))
            columns["n_tokens"].append(len(ids))
            if with_ids:
                columns["ids"].append(np.array(ids, dtype=np.int32))
            columns["ids_sha256"].append(hashlib.sha256(decimal.encode()).hexdigest())
            digest, decoded = hashlib.sha256(), []
            for part in decode_text(decode(ids, transducer.tokens), KEEP_BYTES):
                digest.update(part.encode("utf-8", KEEP_BYTES))
                if with_text:
                    decoded.append(part)
            columns["decoded_sha256"].append(digest.hexdigest())
            if with_text:
                columns["decoded"].append("".join(decoded))
        return columns

    return narrow.mapInArrow(over_batches(rows, schema, keep=key), result)
