"""Two tokenizations of one text, cut into groups where tokens of both end.

A fragment tells what a byte range of a text holds: the tokens up to the first place
where one of each tokenizer ends (open prefix), the groups between that place and the
last such one (closed), and the tokens behind it (open suffix). Fragments of neighbouring
ranges compose, and in whatever order that is done, the result is the same. A range
without such a place has a prefix alone.

Groups are written `a1,a2|b1`: decimal ids of both tokenizers, in order, `;` between them.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator, Sequence
from functools import reduce
from itertools import chain
from typing import NamedTuple

import numpy as np

B_BITS = 32      # a pair of ids is one number: a << B_BITS | b
CACHED = 50_000    # words whose groups a worker remembers when it forgets others, at twice as many
CACHED_BYTES = 8_000_000  # what these words, groups and links take at most
CACHED_CHARS = 48  # of a word that is remembered then
RUN_CHARS = 500    # new words encoded at a time: longer texts take B longer, by the character
WIDE = 1 << 12   # links of a group that are listed one by one; of wider groups distinct ids are paired
COMMA, BAR, SEMICOLON, NOTHING = range(4)

# Fixed: the code points that Unicode calls white space.
WHITE = "".join(
    map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
)
MARK = chr(0x2581)  # a space in pieces of B
# Fixed: how byte-level vocabularies of this kind cut texts before they merge.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Fragment(NamedTuple):
    """What a byte range holds; `closed` is None where nothing closes in it."""

    prefix: str
    closed: str | None
    suffix: str


EMPTY = Fragment("|", None, "")


def join_open(x: str, y: str) -> str:
    """Tokens of an open part, then those of the next."""
    (xa, xb), (ya, yb) = x.split("|"), y.split("|")
    return f"{xa + ',' + ya if xa and ya else xa or ya}|{xb + ',' + yb if xb and yb else xb or yb}"


def compose(x: Fragment, y: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; associative, with `EMPTY` as the neutral one."""
    if x.closed is None:
        return Fragment(join_open(x.prefix, y.prefix), y.closed, y.suffix)
    if y.closed is None:
        return Fragment(x.prefix, x.closed, join_open(x.suffix, y.prefix))
    between = join_open(x.suffix, y.prefix)
    return Fragment(x.prefix, ";".join(p for p in (x.closed, between, y.closed) if p not in ("", "|")), y.suffix)


def compose_all(fragments: Iterable[Fragment]) -> Fragment:
    """By a tree, so that each part is copied a few times only."""
    row = list(fragments)
    while len(row) > 1:
        row = [reduce(compose, row[i : i + 2]) for i in range(0, len(row), 2)]
    return row[0] if row else EMPTY


def groups_of(whole: Fragment) -> str:
    """All groups of a text's fragment."""
    if (whole.prefix if whole.closed is None else whole.suffix) not in ("", "|"):
        raise ValueError("tokens behind the last common end")
    return ";".join(p for p in (whole.prefix, whole.closed) if p not in ("", "|", None))


class Tokens(NamedTuple):
    """Ids of tokens, and the byte behind the last of each."""

    ids: np.ndarray
    ends: np.ndarray

    def within(self, start: int, end: int) -> Tokens:
        """Those that end behind `start`, up to `end`."""
        a, b = np.searchsorted(self.ends, [start, end], side="right")
        return Tokens(self.ids[a:b], self.ends[a:b])


class Groups(NamedTuple):
    """Ids of both tokenizers, and the number of the group of each."""

    a: np.ndarray
    of_a: np.ndarray
    b: np.ndarray
    of_b: np.ndarray
    n: int


def grouped(a: Tokens, b: Tokens) -> Groups:
    """Tokens in groups; those behind the last common end are in a group `n` of their own."""
    last = max((int(t.ends[-1]) for t in (a, b) if len(t.ends)), default=0)
    of_both = np.zeros((2, last + 1), bool)
    of_both[0, a.ends] = of_both[1, b.ends] = True
    upto = np.cumsum(of_both[0] & of_both[1])  # common ends up to each byte
    return Groups(a.ids, upto[a.ends - 1], b.ids, upto[b.ends - 1], int(upto[-1]))


class Writer:
    """Groups as text, by a table of ids with what may stand behind them."""

    def __init__(self, ids: int):
        marks = (b",", b"|", b";", b"")
        self.table = [str(i).encode() + m for i in range(ids) for m in marks]
        self.length = np.array([len(x) for x in self.table], np.int32)

    def write(self, g: Groups) -> bytes:
        """The closed groups; each has tokens of both."""
        return self.write_ends(g)[0]

    def write_ends(self, g: Groups) -> tuple[bytes, np.ndarray]:
        """The closed groups, and where each ends, with the mark behind it."""
        inside_a, inside_b = g.of_a < g.n, g.of_b < g.n
        keys = np.concatenate([g.of_a[inside_a] * 2, g.of_b[inside_b] * 2 + 1])
        ids = np.concatenate([g.a[inside_a], g.b[inside_b]])
        order = np.argsort(keys, kind="stable")
        keys, ids = keys[order], ids[order]
        step = np.diff(keys)
        behind = np.full(len(ids), NOTHING)
        behind[:-1] = np.where(step == 0, COMMA, np.where(keys[:-1] % 2 == 0, BAR, SEMICOLON))
        spelt = ids * 4 + behind
        ends = np.cumsum(self.length[spelt])[(behind == SEMICOLON) | (behind == NOTHING)]
        return b"".join(map(self.table.__getitem__, spelt.tolist())), ends

    def fragment(self, a: Tokens, b: Tokens) -> Fragment:
        """The fragment of a range, given the tokens of both that end in it."""
        g = grouped(a, b)
        rest = "|".join(",".join(map(str, ids[of == g.n].tolist())) for ids, of in ((g.a, g.of_a), (g.b, g.of_b)))
        if not g.n:
            return Fragment(rest, None, "")
        prefix, _, closed = self.write(g).decode().partition(";")
        return Fragment(prefix, closed, rest)


def read_groups(text: str) -> Groups:
    """Groups from their text."""
    if not text:
        none = np.zeros(0, np.int64)
        return Groups(none, none, none, none, 0)
    raw = np.frombuffer(text.encode(), np.uint8)
    at = np.flatnonzero((raw < 48) | (raw > 57))
    marks = raw[at]
    of = np.concatenate([[0], np.cumsum(marks == ord(";"))])
    is_b = np.concatenate([[0], np.cumsum(marks == ord("|"))]) > of
    ends = np.concatenate([at, [len(raw)]])
    digits = np.diff(ends, prepend=-1) - 1
    ids = np.zeros(len(ends), np.int64)
    for i in range(int(digits.max())):
        some = np.flatnonzero(digits > i)
        ids[some] += (raw[ends[some] - 1 - i].astype(np.int64) - 48) * 10**i
    return Groups(ids[~is_b], of[~is_b], ids[is_b], of[is_b], int(of[-1]) + 1)


class Linked(NamedTuple):
    """Counts of groups, the pairs of ids they link, in order, and how often each."""

    n_a: int
    n_b: int
    n_groups: int
    n_links: int
    codes: np.ndarray
    times: np.ndarray


NO_CODES = np.zeros(0, np.int64)
UNLINKED = Linked(0, 0, 0, 0, NO_CODES, NO_CODES)


def condensed(codes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Each code once, in order, with the sum of its times (1 unless given)."""
    if not len(codes):
        return NO_CODES, NO_CODES
    if times is None:
        return np.unique(codes, return_counts=True)
    order = np.argsort(codes)
    codes, times = codes[order], times[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[starts], np.add.reduceat(times, starts)


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ranges, one range behind the other."""
    sizes = sizes.astype(np.int64)
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def narrow_links(g: Groups, links: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """A code for each link of the groups that have at most `WIDE`, in their order."""
    first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    some = np.flatnonzero(links <= WIDE)
    each = links[some]
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    of, width = np.repeat(some, each), np.repeat(n_b[some], each)
    return g.a[first_a[of] + nth // width] << B_BITS | g.b[first_b[of] + nth % width]


def linked(g: Groups) -> Linked:
    """All pairs of a token of each tokenizer inside one group."""
    if not g.n:
        return UNLINKED
    n_a, n_b = np.bincount(g.of_a, minlength=g.n), np.bincount(g.of_b, minlength=g.n)
    links = n_a * n_b
    codes, times = [narrow_links(g, links, n_a, n_b)], None
    if links.max() > WIDE:
        weights = [np.ones(len(codes[0]), np.int64)]
        for i in np.flatnonzero(links > WIDE):
            a, m = np.unique(g.a[g.of_a == i], return_counts=True)
            b, n = np.unique(g.b[g.of_b == i], return_counts=True)
            codes.append((a[:, None] << B_BITS | b).ravel())
            weights.append((m[:, None] * n).ravel())
        times = np.concatenate(weights)
    return Linked(len(g.a), len(g.b), g.n, int(links.sum()), *condensed(np.concatenate(codes), times))


class Column:
    """Numbers in an array that grows."""

    def __init__(self, dtype: type, values: np.ndarray | Sequence = ()):
        self.data, self.n = np.array(values, dtype), len(values)

    def add(self, values: np.ndarray) -> None:
        n = self.n + len(values)
        if n > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros(max(n, 1 << 12), self.data.dtype)])
        self.data[self.n : n] = values
        self.n = n

    @property
    def values(self) -> np.ndarray:
        return self.data[: self.n]


FINE, WIDE_GROUP, NO_TOKENS = range(3)  # WIDE_GROUP: a group whose links `codes` leaves out


class Words(dict):
    """Numbers of words; a word looked up for the first time gets the next one.

    What is known of them is in columns by number: groups, links (a code for each, those
    of a word behind `first`), tokens of A, and how often they were met.
    """

    def __init__(self):
        super().__init__()
        self.new: list[str] = []  # not learnt yet
        self.groups: list[bytes] = []
        self.codes, self.first, self.n_links = Column(np.int64), Column(np.int64), Column(np.int32)
        self.n_a, self.state, self.met = Column(np.int32), Column(np.int8), Column(np.int64)
        self.bytes = 0

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n

    def add(self, groups: list[bytes], codes: np.ndarray, n_links: np.ndarray, n_a: np.ndarray, state: np.ndarray) -> None:
        """What was learnt of the new words, in their order."""
        self.first.add(self.codes.n + np.cumsum(n_links) - n_links)
        self.codes.add(codes)
        for column, values in ((self.n_links, n_links), (self.n_a, n_a), (self.state, state), (self.met, np.zeros(len(groups)))):
            column.add(values)
        self.groups += groups
        self.bytes += sum(map(len, chain(self.new, groups))) + codes.nbytes
        self.new = []

    def codes_of(self, numbers: np.ndarray) -> np.ndarray:
        """The links of words, one word behind the other."""
        return self.codes.data[spread(self.first.data[numbers], self.n_links.data[numbers])]

    def kept(self, size: int, n_bytes: int, chars: int) -> Words:
        """Those of at most `chars` characters met most often, or last, as far as `size` and `n_bytes` go.

        They count as met half as often.
        """
        words, out = list(self), Words()
        length = np.fromiter(map(len, words), np.int64, len(words))
        takes = length + np.fromiter(map(len, self.groups), np.int64, len(words)) + self.n_links.values * 8
        order = np.argsort(self.met.values, kind="stable")[::-1]
        order = order[length[order] <= chars][:size]
        some = np.sort(order[np.cumsum(takes[order]) <= n_bytes])
        for i in some.tolist():
            out[words[i]]  # noqa: B018  numbers it
        out.add([self.groups[i] for i in some.tolist()], self.codes_of(some), *(c.data[some] for c in (self.n_links, self.n_a, self.state)))
        out.met = Column(np.int64, self.met.data[some] // 2)
        return out


def byte_alphabet() -> dict[str, int]:
    """The byte for each character that byte-level vocabularies write in its place.

    Printable bytes stand for themselves, the others for the code points from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class TwoTokenizers:
    """Byte-level BPE (A) and sentencepiece BPE with byte fallback (B) on one text.

    Both see the text with a space before it. Neither tokenizer has a token that goes on
    from another character into white space, but for white space that some piece of B
    takes up, which ends no word. So words (white space and what follows it) can be
    encoded apart: those a worker does not know yet together, and ranges of a long text
    from the words that reach into them.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        alphabet = byte_alphabet()
        self.encode_a, vocabulary = self._byte_level(path_a, alphabet)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        model, pieces = self.b, [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        spelt_a = {i: bytes(alphabet[c] for c in token) for token, i in vocabulary.items()}
        self.a_bytes = [spelt_a.get(i, b"") for i in range(max(spelt_a) + 1)]
        self.b_bytes = [
            bytes([int(p[1:-1], 16)]) if model.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_length, self.b_length = (np.array([len(x) for x in row]) for row in (self.a_bytes, self.b_bytes))
        self.writer = Writer(max(len(self.a_bytes), len(self.b_bytes)))

        longer = [p for i, p in enumerate(pieces) if len(p) > 1 and not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        glue = "".join(sorted({c for p in longer for c in p if c in WHITE}))
        if "\n" in glue or " " in glue or any(MARK in p.lstrip(MARK) for p in longer):
            raise ValueError(f"pieces of {path_b} reach into white space")
        more = f"(?:[{re.escape(glue)}][{WHITE}]*[^{WHITE}]*)*" if glue else ""
        self.words = re.compile(f"[{WHITE}]*[^{WHITE}]+{more}|[{WHITE}]+")
        self.barrier = len(self.b.encode("\n"))
        self.known = Words()

    @staticmethod
    def _byte_level(path: str, alphabet: dict[str, int]):
        """How to encode with a byte-level tokenizers file, and its tokens.

        Where ids are in the order of merges, they are ranks, and the quicker library of
        the same method takes them; otherwise the file's own library encodes.
        """
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, cut = told["model"], told["pre_tokenizer"]
        if cut["type"] != "ByteLevel" or cut["add_prefix_space"] or not cut["use_regex"] or told["normalizer"]:
            raise ValueError(f"{path} is no plain byte-level tokenizer")
        added = {t["content"] for t in told["added_tokens"]}
        vocabulary = {t: i for t, i in model["vocab"].items() if t not in added}
        merged = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged == sorted(set(merged)) and len(merged) + 256 == len(vocabulary):
            import tiktoken

            ranks = {bytes(alphabet[c] for c in t): i for t, i in vocabulary.items()}
            quick = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
            return quick.encode_ordinary, vocabulary
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.encode_special_tokens = True
        library.no_truncation()
        library.no_padding()
        return lambda text: library.encode(text, add_special_tokens=False).ids, vocabulary

    def _tokens(self, text: str, ids_b: list[int]) -> tuple[Tokens, Tokens] | None:
        ids_a, raw = self.encode_a(text), text.encode()
        if any(b"".join(map(spelt.__getitem__, ids)) != raw for ids, spelt in ((ids_a, self.a_bytes), (ids_b, self.b_bytes))):
            return None
        a, b = np.array(ids_a, np.int64), np.array(ids_b, np.int64)
        return Tokens(a, np.cumsum(self.a_length[a])), Tokens(b, np.cumsum(self.b_length[b]))

    def _encoded(self, words: str) -> tuple[Tokens, Tokens] | None:
        # a line end before the words keeps off the space that the library would add
        return self._tokens(words, self.b.encode("\n" + words)[self.barrier :])

    def _ids(self, words: list[str]) -> list[tuple[list[int], list[int]]]:
        """Tokens of words, encoded together, as rows of (A, B); a row for each word without tokens, empty."""
        text = "".join(words)
        rows = self.encode_a(text), self.b.encode("\n" + text)[self.barrier :]
        raw = text.encode()
        if all(b"".join(map(spelt.__getitem__, ids)) == raw for ids, spelt in zip(rows, (self.a_bytes, self.b_bytes), strict=True)):
            return [rows]
        if len(words) == 1:
            self.without.add(text)
            return [([], [])]
        half = len(words) // 2
        return self._ids(words[:half]) + self._ids(words[half:])

    def _learn(self) -> None:
        """The groups and links of new words, encoded in runs."""
        words, self.without = self.known.new, set()
        rows = [r for run in runs_of(words) for r in self._ids(run)]
        found = []
        for side, length in enumerate((self.a_length, self.b_length)):
            ids = np.array(list(chain.from_iterable([r[side] for r in rows])), np.int64)
            found.append(Tokens(ids, np.cumsum(length[ids])))
        g = grouped(*found)
        fine = np.array([w not in self.without for w in words])
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words] * fine)
        # behind the token of A that ends each word, and so behind its last group
        tokens = np.searchsorted(found[0].ends, ends, side="right")
        upto = np.concatenate([[0], np.concatenate([[0], g.of_a + 1])[tokens]])
        both_end = np.isin(ends[fine], found[0].ends, assume_unique=True) & np.isin(ends[fine], found[1].ends, assume_unique=True)
        if not both_end.all() or upto[-1] != g.n or (np.diff(upto)[fine] < 1).any():
            raise ValueError("words that don't end with tokens of both")
        n_a, n_b = np.bincount(g.of_a, minlength=g.n), np.bincount(g.of_b, minlength=g.n)
        links = n_a * n_b
        told, at = self.writer.write_ends(g)
        at = np.concatenate([[0], at])[upto].tolist()
        groups = [told[x:y].rstrip(b";") for x, y in zip(at, at[1:], strict=False)]
        narrow = np.concatenate([[0], np.cumsum(np.where(links <= WIDE, links, 0))])[upto]
        wide = np.diff(np.concatenate([[0], np.cumsum(links > WIDE)])[upto]) > 0
        state = np.where(fine, np.where(wide, WIDE_GROUP, FINE), NO_TOKENS)
        self.known.add(groups, narrow_links(g, links, n_a, n_b), np.diff(narrow), np.diff(tokens, prepend=0), state)

    def texts(self, texts: Sequence[str]) -> Iterator[tuple[bytes, Linked] | None]:
        """Groups and links of whole texts; None for those without tokens.

        Words of all of them that aren't known are learnt together.
        """
        if len(self.known) > 2 * CACHED or self.known.bytes > 2 * CACHED_BYTES:
            self.known = self.known.kept(CACHED, CACHED_BYTES, CACHED_CHARS)
        known, rows = self.known, [self.words.findall(" " + t) if t else [] for t in texts]
        numbers = list(map(known.__getitem__, chain.from_iterable(rows)))
        if known.new:
            self._learn()
        at = np.array(numbers, np.int64)
        known.met.values[:] += np.bincount(at, minlength=len(known))
        codes = known.codes_of(at)
        ends = np.cumsum([len(r) for r in rows])
        state, columns = known.state.data[at], (known.n_links.data[at], known.n_a.data[at])
        of_links, of_a = (np.concatenate([[0], np.cumsum(c, dtype=np.int64)]).tolist() for c in columns)
        wide, bad = (np.concatenate([[0], np.cumsum(state == s)]).tolist() for s in (WIDE_GROUP, NO_TOKENS))
        x = 0
        for y in ends.tolist():
            if x == y or bad[x] < bad[y]:
                yield None
            else:
                groups = b";".join(map(known.groups.__getitem__, numbers[x:y]))
                if wide[x] < wide[y]:
                    yield groups, linked(read_groups(groups.decode()))
                else:
                    mine, n_a, n_groups = codes[of_links[x] : of_links[y]], of_a[y] - of_a[x], groups.count(b";") + 1
                    n_b = n_groups * 2 + groups.count(b",") - n_a  # a bar and a comma or semicolon between any two tokens
                    yield groups, Linked(n_a, n_b, n_groups, len(mine), *condensed(mine))
            x = y

    def forget(self) -> None:
        """Give the memory of known words back."""
        self.known = Words()

    def text(self, text: str) -> tuple[bytes, Linked] | None:
        """Groups and links of a whole text; None if it has no tokens."""
        return next(iter(list(self.texts([text]))))

    def words_of(self, text: str) -> Iterator[str]:
        """The words of a text and the space before it."""
        return (m[0] for m in self.words.finditer(" " + text))

    def range_of(self, words: str, start: int, end: int) -> Fragment | None:
        """The fragment of the tokens that end behind byte `start`, up to byte `end`.

        `words` are those of the text that reach into the range; `start` and `end` are
        counted from the first of them. None if the bytes of tokens aren't those of the
        words.
        """
        found = self._encoded(words)
        return None if found is None else self.writer.fragment(*(t.within(start, end) for t in found))


def runs_of(words: Iterable[str]) -> Iterator[list[str]]:
    """Words to encode together. White space that ends one would join that of the next: it ends the run."""
    run, chars = [], 0
    for w in words:
        run.append(w)
        chars += len(w)
        if chars >= RUN_CHARS or w[-1].isspace():
            yield run
            run, chars = [], 0
    if run:
        yield run


def byte_ranges(words: Iterable[str], size: int) -> Iterator[tuple[str, int, int]]:
    """Byte ranges of about `size`, each with the words that reach into it.

    Gives (words, start, end), both counted from the first byte of those words. A range
    ends after `size` bytes, inside a word too, but for a word longer than that, which
    lies in one range.
    """
    held: list[str] = []
    at = start = done = 0  # bytes of the words so far, from where the range starts, before the held words
    for w in words:
        n = len(w) if w.isascii() else len(w.encode())
        held.append(w)
        at += n
        while at - start >= size:
            end = start + size if n <= size else at
            yield "".join(held), start - done, end - done
            start = end
            held, done = ([], at) if end == at else ([w], at - n)
    if at > start:
        yield "".join(held), start - done, at - done
