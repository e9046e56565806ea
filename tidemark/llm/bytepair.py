"""Byte-level BPE by prefix dynamic programming.

Every byte prefix of a piece has one encoding, so its last token is unique. The
encoder stores that token for each prefix: the last token of ``piece[:i]`` is the
vocabulary entry ``piece[j:i]`` that may follow the last token of ``piece[:j]``.
Two tokens may follow each other if merging their joined bytes by rank never
crosses the border between them. The stored column makes appends exact (go on
where it ends) and lets an edit keep all prefixes before it.

A null text is empty: no tokens. Rows are independent, so ties, repeated rows,
other columns and empty tables need nothing special. A piece of any length is
encoded whole; work for a byte is bounded by the longest token.
"""

from __future__ import annotations

import base64
import hashlib
import re

import regex
from pyspark.sql import DataFrame

from tidemark.llm.common import held_by_worker, map_texts, texts_of

#: Bytes of what a worker remembers of words, pieces, beginnings and pairs of tokens; a bound
#: on memory, not on the work. All of it goes when a task of another operator begins.
WORD_BYTES = 48 << 20
PIECE_BYTES = 24 << 20
HEAD_BYTES = 16 << 20
PAIR_BYTES = 32 << 20
#: What an entry takes beside its text, about.
ENTRY_BYTES = 200
ENDLESS = 1 << 60
#: Bytes of a piece's beginning whose last tokens are remembered for other pieces.
HEAD = 7
#: White space beside white space.
BESIDE = re.compile(r"\s\s").search
#: Fixed value: the split pattern whose pieces hold white space only in front.
LEADING_SPACE = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+"
                 r"|\s+(?!\S)|\s+")

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and their ranks from a file of base64 tokens."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class BytePairs:
    """A vocabulary of ranked tokens with an encoder and a decoder."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self._own_words = pattern == LEADING_SPACE
        self.longest = max(map(len, ranks), default=1)
        self.bytes_of = {str(rank): token for token, rank in ranks.items()}
        self.spelled = {rank: token for token, rank in ranks.items()}
        self._follows: dict[int, bool] = {}
        self._borders: dict[tuple[int, bool], list[tuple[bytes, int]]] = {}
        self._heads: dict[bytes, tuple[list[tuple[int, int]], int]] = {}
        self._grow()
        self._piece_ids = _Known(self._piece, 64, PIECE_BYTES)
        self._first_ids = _Known(self._split, 32, PIECE_BYTES)
        self._word_ids = _Known(self._word, 32, WORD_BYTES)
        self._line_end = f" {ranks.get(b'\n')} "

    def _grow(self) -> None:
        """A tree of the tokens' bytes with, for each node, the node of its longest proper
        suffix and the tokens (rank, length) that its bytes end with, longest first."""
        self._child: dict[int, int] = {}
        at, parent = [0], [(0, 0)]
        named: list[int | None] = [None]
        for token, rank in self.ranks.items():
            node = 0
            for byte in token:
                step = node << 8 | byte
                nxt = self._child.get(step)
                if nxt is None:
                    nxt = self._child[step] = len(named)
                    named.append(None)
                    at.append(at[node] + 1)
                    parent.append((node, byte))
                node = nxt
            named[node] = rank
        self._suffix = [0] * len(named)
        self._ends: list[tuple[tuple[int, int], ...]] = [()] * len(named)
        for node in sorted(range(1, len(named)), key=at.__getitem__):
            up, byte = parent[node]
            if up:
                link = self._suffix[up]
                while link and link << 8 | byte not in self._child:
                    link = self._suffix[link]
                self._suffix[node] = self._child.get(link << 8 | byte, 0)
            below = self._ends[self._suffix[node]]
            rank = named[node]
            self._ends[node] = below if rank is None else ((rank, at[node]), *below)

    def _last_merge(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens that ``token`` is merged from, None for one byte."""
        found = [token[i:i + 1] for i in range(len(token))]
        while len(found) > 2:
            at = min(range(len(found) - 1),
                     key=lambda i: (self.ranks.get(found[i] + found[i + 1], ENDLESS), i))
            found[at:at + 2] = [found[at] + found[at + 1]]
        return (found[0], found[1]) if len(found) == 2 else None

    def _border(self, rank: int, right: bool) -> list[tuple[bytes, int]]:
        """Tokens that lie at an end of a token while it is merged, each with the rank of
        the merge that takes it in; the token itself is never taken in."""
        known = self._borders.get((rank, right))
        if known is None:
            known, until, at = [], ENDLESS, self.spelled[rank]
            while True:
                known.append((at, until))
                halves = self._last_merge(at)
                if halves is None:
                    break
                until, at = self.ranks[at], halves[1 if right else 0]
            self._borders[rank, right] = known
        return known

    def follows(self, left: int, right: int) -> bool:
        """Whether two tokens stay two tokens when their bytes are joined."""
        answer = self._follows.get(left << 32 | right)
        if answer is None:
            # Of equal ranks the leftmost pair is merged first.
            answer = not any(
                (rank := self.ranks.get(a + b, ENDLESS)) < a_until and rank <= b_until
                and rank < ENDLESS
                for a, a_until in self._border(left, True)
                for b, b_until in self._border(right, False))
            if len(self._follows) * ENTRY_BYTES // 2 >= PAIR_BYTES:
                self._follows.clear()
            self._follows[left << 32 | right] = answer
        return answer

    def _walk(self, piece: bytes, start: int, node: int, last: list[tuple[int, int]] | None
              ) -> int:
        """Go on through ``piece`` from ``start``, where the tree stands at ``node``, adding the
        last tokens of the prefixes that end after it; without ``last`` only the node moves."""
        child, suffix, ends, known = self._child, self._suffix, self._ends, self._follows
        for end in range(start, len(piece)):
            byte = piece[end]
            nxt = child.get(node << 8 | byte)
            while nxt is None:
                node = suffix[node]
                nxt = child.get(node << 8 | byte)
            node = nxt
            if last is None:
                continue
            for token in ends[node]:
                begin = end - token[1]
                if begin < 0:
                    break
                before = last[begin][0]
                fits = known.get(before << 32 | token[0])
                if fits or fits is None and self.follows(before, token[0]):
                    break
            last.append(token)
        return node

    def extend(self, piece: bytes, last: list[tuple[int, int]]) -> list[tuple[int, int]]:
        """Complete ``last``: (rank, length) of the last token of each prefix of ``piece``."""
        done = len(last)
        node = self._walk(piece[:done], max(0, done - self.longest), 0, None)
        self._walk(piece, done, node, last)
        return last

    @staticmethod
    def tokens(last: list[tuple[int, int]]) -> list[int]:
        """The encoding that the last tokens of all prefixes spell."""
        found, end = [], len(last) - 1
        while end >= 0:
            rank, length = last[end]
            found.append(rank)
            end -= length
        found.reverse()
        return found

    def encode_piece(self, piece: bytes) -> list[int]:
        # Pieces that begin alike share the tokens of that beginning.
        head = piece[:HEAD]
        last, node = self._heads.get(head, (None, 0))
        if last is None:
            last = []
            node = self._walk(head, 0, 0, last)
            if len(self._heads) * ENTRY_BYTES * 2 < HEAD_BYTES:
                self._heads[head] = last, node
        if len(piece) > HEAD:
            last = last.copy()
            self._walk(piece, HEAD, node, last)
        return self.tokens(last)

    def _piece(self, piece: str) -> str:
        return " ".join(map(str, self.encode_piece(piece.encode())))

    def _split(self, text: str) -> str:
        return " ".join(map(self._piece_ids.__getitem__, self.pieces(text)))

    def _word(self, word: str) -> str:
        pieces = self.pieces(" " + word)
        if len(pieces) == 1:  # what the word remembers need not be remembered twice
            return self._piece(pieces[0])
        return " ".join(map(self._piece_ids.__getitem__, pieces))

    def _line(self, line: str) -> str:
        first, *words = line.split(" ")
        found = list(map(self._word_ids.__getitem__, words))
        return " ".join([self._first_ids[first], *found])

    def encode_text(self, text: str) -> str:
        """Token ids of a text in decimal, separated by one space."""
        # A piece holds one space in front or is white space alone. So where white space
        # stands singly, a line end is a piece, one begins at each space, and what lies
        # between splits alone.
        if (self._own_words and text and not text[0].isspace() and not text[-1].isspace()
                and not BESIDE(text)):
            return self._line_end.join(map(self._line, text.split("\n")))
        return self._split(text)

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.encode_text(text).split()))

    def decode_text(self, ids: str) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids.split()))


class _Known(dict):
    """Remembers what a function gave for short texts; when ``room`` bytes are full it takes
    no more, as frequent ones come early."""

    def __init__(self, find, longest: int, room: int):
        self.find, self.longest, self.left = find, longest, room

    def __missing__(self, text: str) -> str:
        found = self.find(text)
        if self.left > 0 and len(text) <= self.longest:
            self[text] = found
            self.left -= ENTRY_BYTES + len(text) + len(found)
        return found


class EditableText:
    """An encoded text that can be appended to and edited.

    An edit splits again from a piece before it until the pieces fall on old
    borders, and encodes only pieces that are new. Within the first changed piece
    the last tokens of the unchanged prefix are kept.
    """

    def __init__(self, vocabulary: BytePairs, text: str = ""):
        self.vocabulary = vocabulary
        self.text = text
        self.pieces = [(p, vocabulary.extend(p.encode(), [])) for p in vocabulary.pieces(text)]
        self.encoded = len(self.pieces)

    def ids(self) -> list[int]:
        return [t for _, last in self.pieces for t in self.vocabulary.tokens(last)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of ``text[start:end]``."""
        text = self.text[:start] + new + self.text[end:]
        shift = len(text) - len(self.text)
        # A border depends on the piece after it, so go back two pieces.
        ends, at = [], 0
        for piece, _ in self.pieces:
            at += len(piece)
            ends.append(at)
        first = max(0, next((i for i, e in enumerate(ends) if e >= start), len(ends)) - 2)
        begin = ends[first - 1] if first else 0
        old = {e + shift: i for i, e in enumerate(ends) if e >= end}
        fresh, at, rest = [], begin, len(self.pieces)
        past = 0
        # Splitting starts at a border, so the rest of the text splits as in the whole.
        for match in self.vocabulary.pieces(text[begin:]):
            fresh.append(match)
            at += len(match)
            past = past + 1 if at in old and at > start + len(new) else 0
            if past == 2:
                rest = old[at] + 1
                break
        before = self.pieces[first:rest]
        self.pieces[first:rest] = [
            (p, self._encode(p, before[i] if i < len(before) else None))
            for i, p in enumerate(fresh)]
        self.text = text

    def _encode(self, piece: str, was) -> list[tuple[int, int]]:
        raw = piece.encode()
        keep: list[tuple[int, int]] = []
        if was is not None:
            old = was[0].encode()
            same = next((i for i, (a, b) in enumerate(zip(old, raw)) if a != b),
                        min(len(old), len(raw)))
            keep = was[1][:same]
        self.encoded += len(raw) > len(keep)
        return self.vocabulary.extend(raw, list(keep))


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Encode whole texts, decode the ids again, and return counts and digests.

    One row per document: the number of ids, the SHA-256 of the decimal ids joined
    by one space, and the SHA-256 of the bytes decoded from those ids.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        vocabulary = worker_vocabulary(ranks, pattern)

        def work(batch):
            n, ids_digest, back_digest = [], [], []
            for text in batch.column("text").to_pylist():
                ids = vocabulary.encode_text(text)
                n.append(ids.count(" ") + 1 if ids else 0)
                ids_digest.append(hashlib.sha256(ids.encode()).hexdigest())
                back_digest.append(hashlib.sha256(vocabulary.decode_text(ids)).hexdigest())
            return {"doc_id": batch.column("doc_id"), "n_tokens": n,
                    "ids_sha256": ids_digest, "decoded_sha256": back_digest}
        return work
    return map_texts(texts_of(docs), SCHEMA, make, holds=True)


def encode_ids(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """The ids themselves: one row per document with ``doc_id`` and ``ids``."""
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(path))

    def make():
        vocabulary = worker_vocabulary(ranks, pattern)

        def work(batch):
            return {"doc_id": batch.column("doc_id"),
                    "ids": [vocabulary.encode(t) for t in batch.column("text").to_pylist()]}
        return work
    return map_texts(texts_of(docs), "doc_id bigint, ids array<int>", make, holds=True)


def worker_vocabulary(ranks, pattern: str) -> BytePairs:
    """One vocabulary for the tasks that a Python worker runs one after another."""
    key = (len(ranks.value), hash(frozenset(list(ranks.value.items())[-64:])), pattern)
    return held_by_worker(key, lambda: BytePairs(ranks.value, pattern))
