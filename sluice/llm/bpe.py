"""Byte-level BPE files inside Spark tasks: loading, safe split points, and counts at every prefix."""

from __future__ import annotations

import functools
import re
from array import array
from itertools import chain
from operator import sub

import numpy as np

#: Entries a worker keeps of a per-chunk table before it starts a new one: bounds its memory, not the result.
CACHE_ENTRIES = 600_000
#: Chunks after which texts are encoded together: bounds what is held beside the ids.
BATCH_CHUNKS = 1 << 16

#: A space before anything but white space always starts a new piece of the byte-level pre-tokenizer, and what
#: stands before it is cut as if the text ended there. Python's white space includes the pre-tokenizer's.
_SPLIT = re.compile(r" (?!\s|$)")
_HARD = re.compile(r" (?:\s|$)").search
_JOINS = re.compile(r"\s (?!\s|$)").search
MARKS = ".,;:!?"
#: Letters (and numbers that are no digits, which are sorted out later), ASCII digits, ASCII marks but the quote, and
#: a line end before one of them.
_PLAIN = re.compile(r"[^\W\d_]+|[0-9]+|[!-&(-/:-@\[-`{-~]+|\n(?=\S)")


def default_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def load(path: str):
    """The tokenizer of a file, once per process, on the calling thread only."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    if hasattr(tok.model, "_resize_cache"):  # what is asked here is remembered here: the library's own cache only costs time
        tok.model._resize_cache(0)
    return tok


@functools.lru_cache(maxsize=4)
def model_of(path: str):
    """The tokenizer of a file without its pre-tokenizer: takes pieces, as characters of the byte alphabet."""
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import CharDelimiterSplit

    tok = Tokenizer(load(path).model)  # shared, not loaded again
    tok.pre_tokenizer = CharDelimiterSplit("\0")  # no piece holds one
    return tok


def special_strings(tok) -> list[str]:
    return [t.content for t in tok.get_added_tokens_decoder().values()]


def chunks(text: str) -> list[str]:
    """``text`` without the spaces it was split at; every chunk but the first lacks one leading space."""
    return _SPLIT.split(text) if _HARD(text) else text.split(" ")


def trailing_space_joins(text: str) -> bool:
    """Whether some chunk ends in white space, so that a cut after the next chunk's space would join the two."""
    return _JOINS(text) is not None


def plain_pieces(key: str) -> tuple[str, ...] | None:
    """The pieces the pre-tokenizer makes of a chunk of letters, digits, ASCII marks and single line ends, else None.

    ``key`` is the chunk without the space before it, or a NUL and a chunk that has none; the pieces are marked
    likewise. Quotes (which may begin a contraction) and all other characters are left to the library.
    """
    first = key[:1] == "\0"
    text = key[1:] if first else key
    pieces = _PLAIN.findall(text)
    if not pieces or sum(map(len, pieces)) != len(text) or not first and pieces[0] == "\n":
        return None
    if not text.isascii() and not all(p.isascii() or p.isalpha() for p in pieces):
        return None
    return tuple(["\0" + p if first or k else p for k, p in enumerate(pieces)])


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: printable Latin-1 stands for itself, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    other = iter(range(256, 512))
    return [chr(b) if b in set(own) else chr(next(other)) for b in range(256)]


def _steps(counts: list[int]) -> tuple[int, bytes]:
    return (counts[-1] if counts else 0), array("h", map(sub, counts, chain((0,), counts))).tobytes()


class PrefixCounter:
    """Exact token counts at every code-point prefix of a text, by dynamic programming over byte prefixes.

    For each byte prefix of a piece one token can end it: the one that the tokenizer, given that token and the
    last token of what stands before it, leaves as they are. The count is then the count before that token,
    plus one. Whether two tokens stay side by side is asked of the library once per pair.
    """

    def __init__(self, path: str) -> None:
        self.tok = load(path)
        back = {c: b for b, c in enumerate(byte_alphabet())}
        special = set(special_strings(self.tok))
        self.ids = {bytes(back[c] for c in t): i for t, i in self.tok.get_vocab().items() if t not in special}
        #: What can begin a token. A state is the longest of these that ends the bytes read so far.
        self.begins = {t[:k] for t in self.ids for k in range(len(t) + 1)}
        self.states: dict[bytes, int] = {}
        self.suffix: list[bytes] = []
        #: Per state the (length, id) of the tokens that end it, longest first.
        self.ending: list[tuple[tuple[int, int], ...]] = []
        self.moves: dict[int, int] = {}
        self.root = self._state(b"")
        #: Tokens in the model's own alphabet, as its vocabulary writes them.
        self.names = {i: t for t, i in self.tok.get_vocab().items() if t not in special}
        self.tokenize = self.tok.model.tokenize
        self.special = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        self.stays: dict[int, bool] = {}
        self.known: dict[str, tuple[int, bytes]] = {}  # met since the older ones were set aside
        self.older: dict[str, tuple[int, bytes]] = {}
        self.heads: dict[bytes, tuple[list[int], list[int], int]] = {}
        self.marks: dict[str, tuple[int, bytes]] = {}

    def _side_by_side(self, left: int, right: int) -> bool:
        """Whether the pair (or, with ``left`` -1, the token alone) encodes to itself."""
        key = (left + 1) << 32 | right
        got = self.stays.get(key)
        if got is None:
            if len(self.stays) > CACHE_ENTRIES:
                self.stays.clear()
            if left < 0:
                got = [t.id for t in self.tokenize(self.names[right])] == [right]
            else:
                ids = self.tokenize(self.names[left] + self.names[right])
                got = len(ids) == 2 and ids[0].id == left and ids[1].id == right
            self.stays[key] = got
        return got

    def _state(self, suffix: bytes) -> int:
        got = self.states.get(suffix)
        if got is None:
            got = self.states[suffix] = len(self.suffix)
            self.suffix.append(suffix)
            ends = ((len(suffix) - k, self.ids.get(suffix[k:])) for k in range(len(suffix)))
            self.ending.append(tuple((size, t) for size, t in ends if t is not None))
        return got

    def _move(self, key: int) -> int:
        """The state after one more byte; ``key`` holds the state and the byte."""
        if len(self.moves) > CACHE_ENTRIES:
            self.moves.clear()
        suffix = self.suffix[key >> 8] + bytes((key & 255,))
        while suffix not in self.begins:
            suffix = suffix[1:]
        got = self.moves[key] = self._state(suffix)
        return got

    def piece(self, data: bytes) -> list[int]:
        """Token counts at every byte prefix of one pre-tokenizer piece, from the empty one on."""
        n, stays, moves, ending = len(data), self.stays.get, self.moves.get, self.ending
        last, count, done, state = [-1], [0], 0, self.root
        for k in (12, 8, 5):  # pieces that begin alike share their first states
            if n > k and (head := self.heads.get(data[:k])):
                last, count, state = head[0].copy(), head[1].copy(), head[2]
                done = k
                break
        for end in range(done + 1, n + 1):
            key = state << 8 | data[end - 1]
            state = moves(key)
            if state is None:
                state = self._move(key)
            for size, t in ending[state]:
                left = last[end - size]
                fits = stays((left + 1) << 32 | t)
                if self._side_by_side(left, t) if fits is None else fits:
                    last.append(t)
                    count.append(count[end - size] + 1)
                    break
            else:
                raise ValueError(f"no encoding ends a prefix of {data!r}")
            if end < n and (end == 5 or end == 8 or end == 12):
                if len(self.heads) > CACHE_ENTRIES:
                    self.heads.clear()
                self.heads[data[:end]] = last.copy(), count.copy(), state
        return count

    def _at_chars(self, piece: str) -> list[int]:
        """Counts at every code-point prefix of a piece, the empty one left out."""
        data = piece.encode()
        count = self.piece(data)
        if len(data) == len(piece):
            return count[1:]
        following = chain(data[1:], (0,))  # a code point ends before a byte that continues none
        return [c for c, b in zip(count[1:], following) if b & 0xC0 != 0x80]

    def run(self, text: str) -> list[int]:
        """Counts at every code-point prefix of a short text, whatever pieces its prefixes fall into."""
        if (text[1:] if text[:1] == " " else text).isalpha():
            return self._at_chars(text)
        out: list[int] = []
        whole = [(a, b) for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]
        base = 0
        for k, (a, b) in enumerate(whole):
            piece = text[a:b]
            got = self._at_chars(piece)
            if piece[0] == "'" and piece[1:].isalpha():  # a contraction cut short is a quote and letters
                got = [sum(self._at_chars(p[0])[-1] for p in self._pieces(piece[:j])) for j in range(1, len(piece))] + got[-1:]
            before = text[whole[k - 1][0]:a] if k and whole[k - 1][1] == a else ""
            if piece[0].isspace() and before.isspace():  # a cut inside white space makes one piece of the run
                lead = len(piece) - len(piece.lstrip())
                run = self._at_chars(before + piece[:lead])
                under = base - self._at_chars(before)[-1]
                full = base + got[-1]
                got = [under + c - base for c in run[len(before):]] + got[lead:]
                if lead == len(piece):
                    got[-1] = full - base
                    tail = under + run[-1]
                    out += [base + c for c in got[:-1]] + [tail if k + 1 < len(whole) else full]
                    base = full
                    continue
                out += [base + c for c in got]
                base = full
                continue
            out += [base + c for c in got]
            base += got[-1]
        return out

    def _pieces(self, text: str):
        return [(text[a:b],) for _, (a, b) in self.tok.pre_tokenizer.pre_tokenize_str(text)]

    def _chunk(self, key: str) -> tuple[int, bytes]:
        """(count, steps) of a chunk: steps are the changes of the count from one code-point prefix to the next."""
        if key.isalpha():
            return _steps(self._at_chars(" " + key))
        word = key.rstrip(MARKS)
        if word and word is not key and word.isalpha():  # letters, then marks: two pieces that do not meet
            tail = key[len(word):]
            head = self.known.get(word) or self.older.get(word)
            if head is None:
                head = _steps(self._at_chars(" " + word))
            self.known[word] = head
            marks = self.marks.get(tail)
            if marks is None:
                marks = _steps(self.run(tail))
                if len(tail) < 4:
                    self.marks[tail] = marks
            return head[0] + marks[0], head[1] + marks[1]
        pieces = plain_pieces(key)
        if pieces:  # a cut inside one of them ends a piece that begins where it does
            got = [self._plain(p) for p in pieces]
            return sum([g[0] for g in got]), b"".join([g[1] for g in got])
        return _steps(self.run(key[1:] if key[:1] == "\0" else " " + key))

    def _plain(self, key: str) -> tuple[int, bytes]:
        """(count, steps) of one piece of the pre-tokenizer, marked as chunks are."""
        got = self.known.get(key) or self.older.get(key)
        if got is None:
            got = _steps(self._at_chars(key[1:] if key[0] == "\0" else " " + key))
        self.known[key] = got
        return got

    def _segment(self, text: str) -> list[bytes]:
        parts = chunks(text)
        parts[0] = "\0" + parts[0]
        if "\0" in text:  # the mark of a first chunk could be mistaken
            got = [self._chunk(p) if k == 0 or p[:1] != "\0" else None for k, p in enumerate(parts)]
            got = [g or _steps(self.run(" " + p)) for g, p in zip(got, parts)]
        else:
            if len(self.known) > CACHE_ENTRIES // 2:  # frequent chunks are carried over when they are met again
                self.known, self.older = {}, self.known
            known, older = self.known, self.older.get
            for p in set(parts).difference(known):
                known[p] = older(p) or self._chunk(p)
            got = [known[p] for p in parts]
        if not trailing_space_joins(text):
            return [g[1] for g in got]
        out = []
        for k, (count, steps) in enumerate(got):
            before = (parts[k - 1][k == 1:] if k > 1 else parts[0][1:]) if k else ""
            before = before[len(before.rstrip()):] if k else ""
            if before:  # a cut after this chunk's space joins the white space before it
                lone = self._at_chars(before + " ")[-1] - self._at_chars(before)[-1]
                s = np.frombuffer(steps, "<i2").copy()
                s[1:2] += s[0] - lone
                s[0] = lone
                steps = s.tobytes()
            out.append(steps)
        return out

    def counts(self, text: str) -> np.ndarray:
        """Token counts (int32) at every code-point prefix of ``text``, the empty one left out."""
        if not self.special or not self.special.search(text):
            return np.cumsum(np.frombuffer(b"".join(self._segment(text)), "<i2"), dtype=np.int32)
        out, base, at = [], 0, 0
        for m in [*self.special.finditer(text), None]:
            segment = text[at:m.start()] if m else text[at:]
            got = np.cumsum(np.frombuffer(b"".join(self._segment(segment)), "<i2"), dtype=np.int32)
            out.append(base + got)
            if m:
                # cuts inside the special string: ordinary text that may join the end of the segment
                tail = segment[max(0, segment.rfind(" ", 0, len(segment.rstrip()))):]
                under = base + (int(got[-1]) if len(got) else 0) - (self.counts(tail)[-1] if tail else 0)
                inside = self.counts(tail + m.group()[:-1]) if len(m.group()) > 1 else np.empty(0, np.int32)
                base += (int(got[-1]) if len(got) else 0) + 1
                out.append(np.concatenate([under + inside[len(tail):], [base]]).astype(np.int32))
                at = m.end()
        return np.concatenate(out)


@functools.lru_cache(maxsize=4)
def prefix_counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


#: Classes of characters: NUL, which no text here holds, space, line end, other white space, all that is left to the
#: library, and what ``_PLAIN`` calls letters, digits and marks.
_NUL, _SPACE, _END, _WHITE, _ODD, _LETTER, _DIGIT, _MARK = range(8)
#: Characters from here on are left to the library.
_CLASSED = 0x32400
#: Bytes of a piece that are compared as 64-bit numbers; longer pieces are looked up as bytes.
KEY_BYTES = 24
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


@functools.lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """The class of each character below ``_CLASSED``, and of all others at the end."""
    out = np.full(_CLASSED + 1, _ODD, np.uint8)
    for c in range(_CLASSED):
        if chr(c).isalpha():
            out[c] = _LETTER
        elif chr(c).isspace():
            out[c] = _WHITE
    out[[i for i in range(33, 127) if out[i] == _ODD and i != ord("'")]] = _MARK
    out[ord("0"):ord("9") + 1] = _DIGIT
    out[[0, 10, 32]] = _NUL, _END, _SPACE
    return out


class PieceTable:
    """Numbers of pieces and where their ids stand; pieces are keyed by their bytes as three 64-bit numbers.

    An open-addressing table of numbers into arrays, looked up for a whole batch at once; about half the memory of a
    dictionary of strings, and no small objects that keep a worker's memory from being given back.
    """

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.count = self.n_ids = 0
        self.slots = np.full(1 << 12, -1, np.int32)
        self.keys = np.zeros((KEY_BYTES // 8, 1 << 11), np.uint64)
        self.at = np.zeros(1 << 11, np.int32)
        self.size = np.zeros(1 << 11, np.int32)
        self.ids = np.zeros(1 << 13, "<u4")
        self.longer: dict[bytes, int] = {}

    @staticmethod
    def _hash(keys: np.ndarray, bits: int) -> np.ndarray:
        h = keys[0] * np.uint64(0x9E3779B97F4A7C15)
        for k in keys[1:]:
            h = ((h ^ h >> np.uint64(29)) + k) * np.uint64(0xBF58476D1CE4E5B9)
        return ((h ^ h >> np.uint64(32)) * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - bits)).astype(np.int64)

    def reserve(self, n: int) -> None:
        """Room for ``n`` more pieces."""
        want = self.count + n
        if want > len(self.at):
            room = 1 << (want - 1).bit_length()
            grown = np.zeros((len(self.keys), room), np.uint64)
            grown[:, :self.count] = self.keys[:, :self.count]
            self.keys = grown
            self.at, self.size = (np.concatenate([x, np.zeros(room - len(x), np.int32)]) for x in (self.at, self.size))
        if 2 * want > len(self.slots):
            self.slots = np.full(1 << (2 * want - 1).bit_length(), -1, np.int32)
            bare = np.fromiter(self.longer.values(), np.int64, len(self.longer))
            old = np.setdiff1d(np.arange(self.count), bare, assume_unique=True)
            self._seat(self.keys[:, old], old)

    def _seat(self, keys: np.ndarray, numbers: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(numbers, which keys are new) of ``keys``; new ones are numbered on, or as ``numbers`` says."""
        slots, last = self.slots, len(self.slots) - 1
        slot = self._hash(keys, last.bit_length())
        left = np.arange(len(slot))
        out, fresh, step = np.zeros(len(slot), np.int64), [], 0
        while len(left):
            got = slots[slot]
            free = np.flatnonzero(got < 0)
            if len(free):  # of several that claim a slot the last one has it; the others then meet it there
                slots[slot[free]] = free
                won = free[slots[slot[free]] == free]
                mine = left[won]
                if numbers is None:
                    number = np.arange(self.count, self.count + len(won))
                    self.keys[:, number] = keys[:, mine]
                    self.count += len(won)
                    fresh.append(mine)
                else:
                    number = numbers[mine]
                slots[slot[won]] = number
                got = slots[slot]
            same = self.keys[0][got] == keys[0][left]
            for own, new in zip(self.keys[1:], keys[1:]):
                same &= own[got] == new[left]
            out[left[same]] = got[same]
            step += 1
            left, slot = left[~same], slot[~same] + step & last
        return out, np.concatenate(fresh) if fresh else np.zeros(0, np.int64)

    def numbers(self, data: bytes, at: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, which are new) of the pieces of ``data`` at these places; no short one may hold a NUL.

        Of a new piece that stands at several places one is named; its ids are then due from ``learn``.
        """
        self.reserve(len(at))
        out = np.zeros(len(at), np.int64)
        short = np.flatnonzero(size <= KEY_BYTES)
        words = np.ndarray(len(data) + 1, "<u8", data + bytes(KEY_BYTES), strides=(1,))
        words = [words[np.minimum(at[short] + k, len(data))] & _LOW_BYTES[np.clip(size[short] - k, 0, 8)] for k in range(0, KEY_BYTES, 8)]
        out[short], fresh = self._seat(np.stack(words))
        new = [short[fresh]]
        for i in np.flatnonzero(size > KEY_BYTES).tolist():
            piece = data[at[i]:at[i] + size[i]]
            number = self.longer.get(piece)
            if number is None:
                number = self.longer[piece] = self.count
                self.count += 1
                new.append([i])
            out[i] = number
        return out, np.concatenate(new).astype(np.int64)

    def learn(self, numbers: np.ndarray, ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> None:
        """Takes the ids of these pieces, which stand at ``at`` in ``ids``."""
        if self.n_ids + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids[:self.n_ids], np.zeros((1 << (self.n_ids + len(ids)).bit_length()) - self.n_ids, "<u4")])
        self.ids[self.n_ids:self.n_ids + len(ids)] = ids
        self.at[numbers] = at + self.n_ids
        self.size[numbers] = size
        self.n_ids += len(ids)


class IdEncoder:
    """Token ids of texts from the library, which sees each distinct piece once while it is remembered.

    Texts are cut at the spaces that always start a new piece. Chunks of plain characters are cut into pieces here, and
    new pieces go to the library's model in one call, as bytes of its alphabet; any other new chunk goes through the
    whole library. What is remembered is forgotten when it is full.
    """

    def __init__(self, path: str) -> None:
        self.tok = load(path)
        self.model = model_of(path)
        self.strings = special_strings(self.tok)
        self.special = re.compile("|".join(map(re.escape, self.strings)))
        alphabet = byte_alphabet()
        self.space = alphabet[32]
        self.alphabet = {**dict(enumerate(alphabet)), 0: "\0"}  # the NUL sets pieces apart; a plain one holds none
        vocab = self.tok.get_vocab()
        #: Whether a token begins with a space, as the first of a piece does and no other.
        self.begins = np.zeros(max(vocab.values(), default=0) + 1, bool)
        self.begins[[i for t, i in vocab.items() if t[:1] == self.space]] = True
        #: A space before a piece must stay a token of its own, for a piece that has none.
        self.cuts = self.space in vocab and set(self.strings).isdisjoint(t for t in vocab if t[:1] == self.space)
        self.known = PieceTable()

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pieces(self, numbers: np.ndarray, pieces: list[bytes]) -> None:
        """Ids of new plain pieces: one call, cut at the tokens that begin with a space."""
        stand = b"\0".join([p if p[0] == 32 else b" \0" + p for p in pieces]).decode("latin-1").translate(self.alphabet)
        ids = np.array(self.model.encode_batch_fast([stand.split("\0")], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        cuts = np.flatnonzero(self.begins[ids])
        if len(cuts) != len(pieces):
            raise ValueError("a piece does not begin with a token of its own")
        bare = np.fromiter([p[0] != 32 for p in pieces], np.int64, len(pieces))  # without the lone space
        self.known.learn(numbers, ids, cuts + bare, np.diff(cuts, append=len(ids)) - bare)

    def _cut(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, which are NULs, which are chunks left to the library) of what ``text`` falls into.

        ``text`` begins and ends with a NUL, as do the texts it is made of; each NUL is a part of its own.
        """
        kind = char_classes()[np.minimum(np.frombuffer(text.encode("utf-32-le"), "<u4"), _CLASSED)]
        blank, space = kind <= _WHITE, kind == _SPACE
        split = space.copy()  # a space before anything but white space
        split[:-1] &= ~blank[1:]
        odd = (kind == _WHITE) | (kind == _ODD)
        odd[:-1] |= (space | (kind == _END))[:-1] & blank[1:]
        if any(s in text for s in self.strings):
            odd[[m.start() for m in self.special.finditer(text)]] = True
        marks = split | (kind == _NUL)
        start = marks.copy()
        start[1:] |= (kind[1:] != kind[:-1]) & ~split[:-1]
        left = np.zeros(len(kind), bool)
        if odd.any():
            chunks_at = np.flatnonzero(marks)
            k = np.unique(np.searchsorted(chunks_at, np.flatnonzero(odd), "right") - 1)
            first, stop = chunks_at[k], chunks_at[k + 1]
            inside = np.zeros(len(kind) + 1, np.int32)
            inside[first + 1] += 1
            np.subtract.at(inside, stop, 1)
            start &= np.cumsum(inside[:-1]) == 0
            first = first + (kind[first] == _NUL)
            start[first] = left[first] = True
        at = np.flatnonzero(start)
        return at, kind[at] == _NUL, left[at]

    def _settle(self, texts: list[str]) -> list[bytes]:
        joined = "\0".join(["", *texts, ""])
        data = joined.encode()
        at, nul, left = self._cut(joined)
        if len(data) > len(joined):
            at = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)[at]
        length = np.diff(at, append=len(data))
        known = self.known
        if known.count > CACHE_ENTRIES:
            known.clear()
        some = np.flatnonzero(~nul)
        numbers, new = known.numbers(data, at[some], length[some])
        odd = left[some[new]]

        def bytes_of(which: np.ndarray) -> list[bytes]:
            begin = at[some[which]]
            return [data[a:b] for a, b in zip(begin.tolist(), (begin + length[some[which]]).tolist())]

        if not odd.all():
            self._learn_pieces(numbers[new[~odd]], bytes_of(new[~odd]))
        if odd.any():
            ids = self._whole([p.decode() for p in bytes_of(new[odd])])
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            known.learn(numbers[new[odd]], np.concatenate(ids), np.cumsum(size) - size, size)
        size = np.zeros(len(at), np.int64)
        size[some] = known.size[numbers]
        stops = np.cumsum(size)
        ids = known.ids[np.repeat(known.at[numbers] - (stops - size)[some], size[some]) + np.arange(stops[-1])].tobytes()
        bounds = (4 * stops[nul]).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, per text."""
        out: list[bytes | None] = [None] * len(texts)
        held: list[int] = []
        n = 0

        def settle() -> None:
            nonlocal n
            for k, got in zip(held, self._settle([texts[k] for k in held]), strict=True):
                out[k] = got
            held.clear()
            n = 0

        for k, t in enumerate(texts):
            if "\0" in t or not self.cuts:  # the NUL sets texts apart
                out[k] = self._whole([t])[0].tobytes()
                continue
            held.append(k)
            n += len(t) // 8 + 1  # about as many chunks
            if n > BATCH_CHUNKS:
                settle()
        if held:
            settle()
        return out


@functools.lru_cache(maxsize=4)
def id_encoder(path: str) -> IdEncoder:
    return IdEncoder(path)
