"""Operator 4: byte-level BPE encoding and decoding.

Encoding compiles the merge ranks into a finite-state transducer that is
determinised lazily.  A BPE encoding is the one token sequence of a byte
string in which every adjacent pair encodes to itself, so the last token of
every prefix follows from shorter prefixes.  After some bytes, only the
positions from which a vocabulary entry may still run on (the trie says
which) can be future token borders; a state is those positions, each with
its trie node and last token.  Reading a byte gives the next state and the
last token of the prefix so far.  The tokens on which the ways back from
all these positions agree are emitted, so the lookahead is bounded by the
longest vocabulary entry.  States and transitions are made when first met,
kept, and dropped together when they exceed a bound (a cache, not a limit).
Pieces that a slice of texts meets for the first time read their bytes side by
side, each from its own state; long pieces go one by one.

Two merges of adjacent entries never cross: an entry's outer parts and the
ranks at which each is merged away tell whether a pair would have merged
over its border first.

Decoding looks the ids up and feeds the bytes through an incremental UTF-8
state machine that carries an unfinished character over to the next chunk.

Null text: as the empty text (no tokens).  Texts are processed whole, a
bounded run of pieces at a time.  Rows are independent: repeated rows and
null ids give a row each; extra columns are ignored.  Empty table: no rows.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import sys
from array import array
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession

from carestar.llm.common import pick, read_table, slices, small_batches

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
# Caches of a worker, in bytes as estimated: with the batch at hand (SLICE)
# a worker stays near 300 MB whatever the texts hold.
MACHINE_BYTES = 80 << 20  # states and transitions, then the machine starts afresh
PAIR_BYTES = 24 << 20     # tested pairs of entries
MEMO_BYTES = 16 << 20     # each of the two generations of a memo
SLICE = 1 << 20           # bytes of text whose ids are held together
RUN = 65_536           # pieces encoded between two digest updates
STRETCH = 1 << 19      # characters split into words at a time
SETTLE = 4_096         # bytes of one piece between two emissions
ABREAST = 256          # bytes of a piece that reads beside others, at most
TOGETHER = 1 << 17     # bytes of the pieces that read side by side
FEW = 8                # pieces that are not worth reading side by side
NEVER = 1 << 60

# A match of PATTERN never runs over a space that stands before a character
# other than white space, and such a space begins a match.
BORDER = re.compile(r" (?=\S)")
NO_BORDER = re.compile(r" (?!\S)")
# Letters in every version of Unicode: after a space one match of PATTERN.
LETTERS = re.compile("[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u02c1]+")


class Transitions:
    """A hash table in arrays: key of a transition to next state and token."""

    def __init__(self, bits: int = 12):
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.next = np.zeros(1 << bits, np.int64)
        self.token = np.zeros(1 << bits, np.int32)

    def slots(self, key: np.ndarray) -> np.ndarray:
        """Where the keys stand, or else the free place they would take."""
        at = (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
              >> np.uint64(64 - self.bits)).view(np.int64)
        there = self.keys[at]
        rest = np.flatnonzero((there != key) & (there >= 0))
        while len(rest):
            at[rest] = at[rest] + 1 & len(self.keys) - 1
            there = self.keys[at[rest]]
            rest = rest[(there != key[rest]) & (there >= 0)]
        return at

    def put(self, key: np.ndarray, nxt: np.ndarray, token: np.ndarray) -> None:
        """Distinct new keys."""
        while 2 * (self.used + len(key)) > len(self.keys):
            old = np.flatnonzero(self.keys >= 0)
            held = self.keys[old], self.next[old], self.token[old]
            self.__init__(self.bits + 1)
            self.put(*held)
        self.used += len(key)
        while len(key):
            at = self.slots(key)
            self.keys[at] = key                # of keys with one place the last
            own = self.keys[at] == key
            self.next[at[own]], self.token[at[own]] = nxt[own], token[own]
            key, nxt, token = key[~own], nxt[~own], token[~own]


class Transducer:
    """Lazily determinised transducer from bytes to token ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.length = {i: len(b) for b, i in ranks.items()}
        self.trie: dict[int, int] = {}
        self.token_at: dict[int, int] = {}
        self.depth = [0]
        for word, token in ranks.items():
            at = 0
            for byte in word:
                key = at << 8 | byte
                nxt = self.trie.get(key)
                if nxt is None:
                    nxt = self.trie[key] = len(self.depth)
                    self.depth.append(self.depth[at] + 1)
                at = nxt
            self.token_at[at] = token
        self.lengths = np.zeros(max(self.length, default=0) + 1, np.int64)
        self.lengths[list(self.length)] = list(self.length.values())
        self.ended = np.full(len(self.depth), -1, np.int64)  # token of a trie node
        self.ended[list(self.token_at)] = list(self.token_at.values())
        self.children = Transitions()
        nodes = np.array(list(self.trie.values()), np.int64)
        self.children.put(np.array(list(self.trie), np.int64), nodes, nodes)
        self.pairs: dict[int, bool] = {}
        self._fresh()

    def forget(self) -> None:
        """Drop everything that was found out from texts."""
        self.pairs.clear()
        self._fresh()

    def _fresh(self) -> None:
        self.sides: dict[int, tuple | None] = {}
        start = b"\0" * 8  # a live position: its trie node << 32 | its last token + 1
        self.states = [start]
        self.number = {start: 0}
        self.delta: dict[int, tuple[int, int]] = {}
        self.met = Transitions()
        self.held = 0

    def outer_parts(self, token: int) -> tuple | None:
        """(first parts, last parts) the entry has while it is merged from
        its bytes: (part, rank of the merge that takes it away).  None: the
        merges never yield the entry."""
        known = self.sides.get(token, False)
        if known is not False:
            return known
        ranks, data = self.ranks, self.bytes_of[token]
        parts = [data[i:i + 1] for i in range(len(data))]
        firsts, lasts = [], []
        while len(parts) > 1:
            best, where = min((ranks.get(parts[i] + parts[i + 1], NEVER), i)
                              for i in range(len(parts) - 1))
            if best == NEVER:
                self.sides[token] = None
                return None
            if where == 0:
                firsts.append((parts[0], best))
            if where == len(parts) - 2:
                lasts.append((parts[-1], best))
            parts[where:where + 2] = [parts[where] + parts[where + 1]]
        firsts.append((data, NEVER))
        lasts.append((data, NEVER))
        self.sides[token] = (firsts, lasts)
        return self.sides[token]

    def follows(self, left: int, right: int) -> bool:
        """May ``right`` stand after ``left`` (-1: at the start)?

        Merges go by rank, then from the left.  A merge over the border
        comes first if its rank is below the one that takes the left part
        away and not above the one that takes the right part away.
        """
        if left < 0:
            return self.outer_parts(right) is not None
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) * 120 > PAIR_BYTES:
                self.pairs.clear()
            own, other = self.outer_parts(left), self.outer_parts(right)
            known = own is not None and other is not None and self._apart(own[1], other[0])
            self.pairs[key] = known
        return known

    def _apart(self, lasts: list, firsts: list) -> bool:
        rank_of = self.ranks.get
        for x, until in lasts:
            for y, till in firsts:
                rank = rank_of(x + y, NEVER)
                if rank < until and rank <= till:
                    return False
        return True

    def step(self, state: int, byte: int) -> tuple[int, int]:
        """Determinise one transition: next state (times 256), last token of
        the prefix."""
        alive, newest = [], -1
        for live in array("q", self.states[state]):
            nxt = self.trie.get(live >> 32 << 8 | byte)
            if nxt is None:
                continue
            last = live & 0xFFFFFFFF
            alive.append(nxt << 32 | last)
            if newest < 0:
                token = self.token_at.get(nxt)
                if token is not None and self.follows(last - 1, token):
                    newest = token
        alive.append(newest + 1)
        return self._state(array("q", alive).tobytes()), newest

    def _state(self, alive: bytes) -> int:
        """Number (times 256, as the key of a transition begins) of a state."""
        number = self.number.get(alive)
        if number is None:
            number = self.number[alive] = len(self.states)
            self.states.append(alive)
            self.held += 180 + len(alive)
        return number << 8

    def _steps(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``step`` for many transitions."""
        held = [self.states[k] for k in (keys >> 8).tolist()]
        live = np.frombuffer(b"".join(held), np.int64)
        own = np.repeat(np.arange(len(keys)), np.fromiter(map(len, held), np.int64, len(held)) // 8)
        way = live >> 32 << 8 | (keys & 255)[own]
        at = self.children.slots(way)
        on = self.children.keys[at] == way
        own, last, node = own[on], live[on] & 0xFFFFFFFF, self.children.next[at[on]]
        token, newest = self.ended[node], np.full(len(keys), -1, np.int64)
        tests = np.flatnonzero(token >= 0)
        while len(tests):  # the first candidate of each, then the next ones
            first = np.ones(len(tests), bool)
            first[1:] = own[tests[1:]] != own[tests[:-1]]
            at = tests[first]
            good = [self.follows(*x) for x in zip((last[at] - 1).tolist(), token[at].tolist())]
            at = at[good]
            newest[own[at]] = token[at]
            tests = tests[~first]
            tests = tests[newest[own[tests]] < 0]
        stop = np.cumsum(np.bincount(own, minlength=len(keys)) + 1)
        alive = np.empty(int(stop[-1]), np.int64)
        older = np.ones(len(alive), bool)
        older[stop - 1] = False
        alive[older], alive[stop - 1] = node << 32 | last, newest + 1
        raw, ends = alive.tobytes(), (8 * stop).tolist()
        numbers = [self._state(raw[a:b]) for a, b in zip([0, *ends], ends)]
        return np.array(numbers, np.int64), newest

    def _remembered(self, state: int, byte: int) -> tuple[int, int]:
        self.held += 220
        out = self.delta[state << 8 | byte] = self.step(state, byte)
        return out

    def _read(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Transitions side by side: next states (times 256), last tokens."""
        at = self.met.slots(key)
        missing = self.met.keys[at] != key
        if missing.any():
            new = np.unique(key[missing])
            self.held += 64 * len(new)
            self.met.put(new, *self._steps(new))
            at = self.met.slots(key)
        return self.met.next[at], self.met.token[at]

    def encode_all(self, pieces: list[bytes]):
        """Token ids (packed, 4 bytes each) of each of the pieces, none of them empty."""
        if len(pieces) < FEW:
            yield from map(self._packed, pieces)
            return
        part, held = [], 0
        for piece in pieces:
            if part and held + len(piece) > TOGETHER:
                yield from self._abreast(part)
                part, held = [], 0
            part.append(piece)
            held += len(piece)
        yield from self._abreast(part)

    def _packed(self, piece: bytes) -> bytes:
        return array("i", self.encode(piece)).tobytes()

    def _abreast(self, pieces: list[bytes]):
        if self.held > MACHINE_BYTES:
            self._fresh()
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        order = np.argsort(-size, kind="stable")
        order = order[size[order] <= ABREAST]
        data = np.frombuffer(b"".join(pieces), np.uint8)
        start, size = (np.cumsum(size) - size)[order], size[order]
        # Last token of every prefix: the pieces longer than k come first.
        ends = np.zeros(len(data), np.int32)
        state = np.zeros(len(order), np.int64)
        longer = len(order) - np.cumsum(np.bincount(size, minlength=1))
        for k, n in enumerate(longer[:-1].tolist()):
            place = start[:n] + k
            state[:n], ends[place] = self._read(state[:n] | data[place])
        # Ways back, last token first.
        at, rows, steps = size.copy(), np.arange(len(order)), []
        while len(rows):
            token = ends[start[rows] + at[rows] - 1]
            steps.append((rows, token))
            at[rows] -= self.lengths[token]
            rows = rows[at[rows] > 0]
        count = np.zeros(len(pieces), np.int64)
        for rows, _ in steps:
            count[order[rows]] += 1
        stop = np.cumsum(count)
        flat = np.zeros(int(stop[-1]), np.int32)
        for k, (rows, token) in enumerate(steps):
            flat[stop[order[rows]] - 1 - k] = token
        flat = flat.tobytes()
        for piece, n, to in zip(pieces, (4 * count).tolist(), (4 * stop).tolist()):
            yield flat[to - n:to] if n else self._packed(piece)

    def _way_back(self, ends: list[int], at: int) -> list[int]:
        """The tokens up to border ``at``, last first."""
        out = []
        while at > 0:
            out.append(ends[at - 1])
            at -= self.length[ends[at - 1]]
        return out

    def _settle(self, ends: list[int], state: int) -> tuple[list[int], int]:
        """(tokens on which all live positions agree, where they end)."""
        ways = [self._way_back(ends, len(ends) - self.depth[live >> 32])[::-1]
                for live in array("q", self.states[state])]
        agreed = 0
        while all(len(w) > agreed and w[agreed] == ways[0][agreed] for w in ways):
            agreed += 1
        out = ways[0][:agreed]
        return out, sum(self.length[t] for t in out)

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self.ranks.get(piece)
        if whole is not None:  # an entry of the vocabulary stands for itself
            return [whole]
        if self.held > MACHINE_BYTES:
            self._fresh()
        out: list[int] = []
        ends: list[int] = []  # last token of every prefix from the last emission on
        state, get = 0, self.delta.get
        for at in range(0, len(piece), SETTLE):
            if at:
                done, to = self._settle(ends, state >> 8)
                out += done
                del ends[:to]
            for byte in piece[at:at + SETTLE]:
                state, token = get(state | byte) or self._remembered(state >> 8, byte)
                ends.append(token)
        return out + self._way_back(ends, len(ends))[::-1]


class Utf8Stream:
    """Incremental UTF-8 decoding: state = bytes of a character begun."""

    def __init__(self):
        self.begun = b""

    def feed(self, chunk: bytes) -> str:
        data = self.begun + chunk
        cut = len(data)
        for back in range(1, min(3, len(data)) + 1):  # an open lead byte near the end?
            byte = data[-back]
            if byte & 0xC0 == 0x80:
                continue
            need = 4 if byte >= 0xF0 else 3 if byte >= 0xE0 else 2 if byte >= 0xC0 else 1
            if need > back:
                cut = len(data) - back
            break
        self.begun = data[cut:]
        return data[:cut].decode("utf-8", errors="replace")

    def end(self) -> str:
        rest, self.begun = self.begun, b""
        return rest.decode("utf-8", errors="replace")


class Memo:
    """A cache bounded in bytes: what was not met for a generation goes."""

    def __init__(self):
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.held = 0

    def unknown(self, keys: set[str]) -> set[str]:
        """Those of the keys that have to be made."""
        if self.held > MEMO_BYTES:
            self.older, self.known, self.held = self.known, {}, 0
        new = keys.difference(self.known)
        back = {k: self.older[k] for k in new if k in self.older}
        self.put(back)
        return new.difference(back)

    def put(self, made: dict[str, bytes]) -> dict[str, bytes]:
        """What is known then, for a while also of long keys."""
        short = made if all(len(k) <= 64 for k in made) else {
            k: v for k, v in made.items() if len(k) <= 64}
        self.known.update(short)
        self.held += 190 * len(short) + sum(map(len, short)) + sum(map(len, short.values()))
        return self.known if short is made else self.known | made


def _joined(table: pa.Array, ids: np.ndarray) -> bytes:
    """The values at the ids, one after the other."""
    taken = table.take(pa.array(ids))
    ends = np.frombuffer(taken.buffers()[1], np.int64)
    return taken.buffers()[2].to_pybytes()[:ends[len(ids)]]


class Codec:
    """Text to ids and back with one vocabulary file."""

    def __init__(self, path: str = VOCABULARY, pattern: str = PATTERN):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.machine = Transducer(self.ranks)
        every = range(len(self.machine.lengths))
        self.shown = pa.array([b"%d " % i for i in every], pa.large_binary())
        self.raw = pa.array([self.machine.bytes_of.get(i, b"") for i in every], pa.large_binary())
        self.split = regex.compile(pattern)
        self.by_word = pattern == PATTERN
        self.forget()

    def forget(self) -> None:
        """Caches are a task's: a worker that turns to other work is small."""
        self.machine.forget()
        # Packed ids of a piece, and of a word after a space.
        self.pieces, self.words = Memo(), Memo()

    def _of_pieces(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of the pieces; those met for the first time are encoded together."""
        made, new, texts = {}, [], []
        for piece in self.pieces.unknown(pieces):
            text = piece.encode("utf-8")
            whole = self.ranks.get(text)
            if whole is None:
                new.append(piece)
                texts.append(text)
            else:
                made[piece] = whole.to_bytes(4, sys.byteorder)
        made.update(zip(new, self.machine.encode_all(texts)))
        return self.pieces.put(made)

    def _of_words(self, words: set[str]) -> dict[str, bytes]:
        """Ids of the words, each with the space before it."""
        one, more = [], {}
        for word in self.words.unknown(words):
            if LETTERS.fullmatch(word):
                one.append(word)
            else:
                more[word] = self.split.findall(" " + word)
        alone = [" " + w for w in one]
        known = self._of_pieces(set(chain(alone, *more.values())))
        made = {w: known[p] for w, p in zip(one, alone)}
        made |= {w: b"".join([known[p] for p in m]) for w, m in more.items()}
        return self.words.put(made)

    def _stretches(self, text: str):
        """(beginning, words that follow a space each) of parts of the text."""
        at, lead = 0, ""
        while at < len(text):
            cut = BORDER.search(text, at + STRETCH) if self.by_word else None
            to = cut.start() if cut else len(text)
            first, *rest = self._stretch(text[at:to])
            yield lead + first, rest
            at, lead = to + 1, " "

    def _encoded(self, stretches, known: dict[str, bytes]):
        for first, rest in stretches:
            pieces = map(regex.Match.group, self.split.finditer(first))
            while run := list(islice(pieces, RUN)):
                own = self._of_pieces(set(run))
                yield np.frombuffer(b"".join([own[p] for p in run]), np.int32)
            if rest:
                yield np.frombuffer(b"".join([known[w] for w in rest]), np.int32)

    def decimals(self, ids: np.ndarray) -> bytes:
        """The ids as decimal numbers joined by one space."""
        return _joined(self.shown, ids)[:-1]

    def bytes_of(self, ids: np.ndarray) -> bytes:
        return _joined(self.raw, ids)

    def runs(self, text: str):
        """Ids of successive bounded runs of the text."""
        for stretch in self._stretches(text):
            yield from self._encoded([stretch], self._of_words(set(stretch[1])))

    def runs_of(self, texts):
        """The runs of each of the texts; what short ones meet for the first
        time is encoded together."""
        held, size = [], 0

        def done():
            known = self._of_words({w for parts in held for _, rest in parts for w in rest})
            return [self._encoded(parts, known) for parts in held]

        for text in texts:
            if held and size + len(text) > STRETCH:
                yield from done()
                held, size = [], 0
            if len(text) > STRETCH:
                yield self.runs(text)
            else:
                held.append(list(self._stretches(text)))
                size += len(text)
        yield from done()

    def _stretch(self, text: str) -> list[str]:
        """The text, split at borders (at every space, if all are borders)."""
        if not self.by_word:
            return [text]
        return BORDER.split(text) if NO_BORDER.search(text) else text.split(" ")

    def encode(self, text: str) -> list[int]:
        return [i for ids in self.runs(text) for i in ids.tolist()]

    def decode(self, ids: list[int]) -> str:
        stream, table = Utf8Stream(), self.machine.bytes_of
        out = [stream.feed(b"".join([table[i] for i in ids[k:k + RUN]]))
               for k in range(0, len(ids), RUN)]
        return "".join(out) + stream.end()


_CODECS: dict[str, Codec] = {}


def codec(path: str = VOCABULARY) -> Codec:
    """One codec per worker process and vocabulary."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str = VOCABULARY, with_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and (optionally) ids."""
    ids_field = ", ids array<int>" if with_ids else ""
    small_batches(docs)

    def run(batches):
        own = codec(path)
        try:
            for batch in batches:
                for part in slices(batch, size=SLICE):
                    yield encoded(own, part)
                batch = part = None
                pa.default_memory_pool().release_unused()
        finally:
            own.forget()
            gc.collect()

    def encoded(own, part):
        counts, digests, backs, at, kept = [], [], [], [0], array("i")
        for runs in own.runs_of(part.column("text").fill_null("").to_pylist()):
            digest, back, stream = hashlib.sha256(), hashlib.sha256(), Utf8Stream()
            count = 0
            for ids in runs:
                if count:
                    digest.update(b" ")
                digest.update(own.decimals(ids))
                count += len(ids)
                back.update(stream.feed(own.bytes_of(ids)).encode("utf-8"))
                if with_ids:
                    kept.frombytes(ids.tobytes())
            back.update(stream.end().encode("utf-8"))
            counts.append(count)
            digests.append(digest.hexdigest())
            backs.append(back.hexdigest())
            at.append(len(kept))
        out = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests, pa.string()),
               pa.array(backs, pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            flat = pa.Array.from_buffers(pa.int32(), len(kept), [None, pa.py_buffer(kept.tobytes())])
            out.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), flat))
            names.append("ids")
        return pa.RecordBatch.from_arrays(out, names=names)

    return pick(docs, doc_id="bigint", text="string").mapInArrow(
        run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ids_field)


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), with_ids=False)
