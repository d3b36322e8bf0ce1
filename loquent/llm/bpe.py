"""Byte-pair encoding and decoding with a deterministic automaton over tokens.

The automaton reads tokens. Its paths are exactly the tokenizations that the
merges produce, so of all ways to cut a word into tokens one is a path, and that
one is the encoding. It is built by one gadget per merge (u, v), in order:

* whatever state reads ``u`` leads to a new copy of ``u``'s old state which has
  no arc ``v`` any more;
* whatever state has an arc ``u`` gets an arc ``uv``, to where ``v`` leads.

All arcs of one label lead to one state, so a state is named by the token read
last. Copies share what they did not change: kept are only the step at which a
token's state lost an arc, and what each token was made of, and when.
``Automaton.open`` goes back from the last step to where the arc was lost or both
were single bytes, which have all arcs; the answers are kept in a table of transitions.
"""

from __future__ import annotations

import hashlib
import json
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, count, pairwise

import numpy as np
import regex
from pyspark.sql import DataFrame

from loquent.llm.common import map_columns

# The pattern that parts text before merges are applied.
PATTERN = (
    r" ?\p{L}++|'s|'t|'re|'ve|'m|'ll|'d| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
)
#: Words of up to so many bytes are kept with their ids, at most so many words: some
#: 15 MB a worker. Most further words of a large corpus are never met again.
KEPT_LENGTH = 48
KEPT_WORDS = 1 << 15
#: Texts are encoded together until they have so many characters.
TOGETHER = 1 << 20
#: Answers kept in the transition table; others are worked out anew.
TABLE = 1 << 19
#: Bytes of a word from which the longest token that may follow is known.
HEAD = 4


def byte_letters() -> dict[str, int]:
    """The character that stands for each byte in vocabulary files."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    letters = {chr(b): b for b in shown}
    letters.update({chr(256 + i): b for i, b in enumerate(hidden)})
    return letters


class Automaton:
    """The token automaton of a vocabulary and its ordered merges."""

    def __init__(self, vocabulary: dict[bytes, int], merges: list[tuple[bytes, bytes]]):
        self.label = {i: t for t, i in vocabulary.items()}
        self.id = vocabulary
        self.size = size = max(vocabulary.values(), default=-1) + 1
        # By token: the arc it was first opened beside, the token whose state its
        # arcs lead to a copy of, and the step at which it was made.
        self.beside = [-1] * size
        self.follows = [-1] * size
        self.made = [-1] * size
        #: By token and arc: the step at which the state of the one lost the other.
        self.lost: dict[int, int] = {}
        self.last = len(merges)
        self.table: dict[int, bool] = {}
        for step, (left, right) in enumerate(merges):
            self._gadget(step, vocabulary[left], vocabulary[right], vocabulary[left + right])
        #: The longest token by its first bytes.
        self.reach: dict[bytes, int] = {}
        for token in vocabulary:
            if len(token) >= HEAD:
                head = token[:HEAD]
                self.reach[head] = max(self.reach.get(head, 0), len(token))

    def _gadget(self, step: int, u: int, v: int, uv: int) -> None:
        self.lost[u * self.size + v] = step
        self.beside[uv] = u
        self.follows[uv] = v
        self.made[uv] = step

    def open(self, state: int, token: int) -> bool:
        """Whether the state after the token ``state`` has an arc ``token``."""
        lost, made, size = self.lost.get, self.made, self.size
        at, label, before = state, token, self.last
        free = None
        while free is None:
            first, second = made[at], made[label]
            step = lost(at * size + label)
            if step is not None and first < step < before and second < step:
                free = False
            elif first > second:
                at, before = self.follows[at], first
            elif second >= 0:
                # Its own step first takes the arc ``v`` away, then gives arcs ``uv``.
                label, before = self.beside[label], second + 1
            else:
                free = True
        if len(self.table) < TABLE:
            self.table[state * size + token] = free
        return free

    def encode(self, word: bytes) -> list[int]:
        """Ids of one pre-split word.

        The longest open arc is taken first; a position from which no arc goes
        on is dead, and the arc before it gives way to the next shorter one.
        Every position has at most one path from the start, hence one state, so
        a dead position is never tried again: the work is linear in the word
        times the longest token.
        """
        ids, label, reach, table = self.id, self.label, self.reach.get, self.table.get
        size, short = self.size, HEAD - 1
        path: list[int] = []
        dead: set[int] = set()
        n, at, last = len(word), 0, -1
        end = min(n, reach(word[:HEAD], short))
        while at < n:
            row = last * size
            while end > at:
                token = ids.get(word[at:end])
                if token is not None and end not in dead:
                    free = last < 0 or table(row + token)
                    if self.open(last, token) if free is None else free:
                        break
                end -= 1
            if end > at:
                path.append(token)
                at, last = end, token
                end = min(n, at + reach(word[at : at + HEAD], short))
            else:
                dead.add(at)
                end = at - 1
                at -= len(label[path.pop()])
                last = path[-1] if path else -1
        return path


class Words:
    """Packed ids of words; ``kept`` has those of words met before."""

    def __init__(self, automaton: Automaton, added: dict[str, int]):
        self.automaton = automaton
        self.added = {t: [i] for t, i in added.items()}
        self.kept: dict[str, bytes] = {}

    def _encode(self, words: list[str]) -> Iterator[bytes]:
        encode, added = self.automaton.encode, self.added.get
        ids: list[int] = []
        ends = [0]
        for word in words:
            ids += added(word) or encode(word.encode("utf-8"))
            ends.append(4 * len(ids))
        packed = np.array(ids, "<u4").tobytes()
        return (packed[a:b] for a, b in pairwise(ends))

    def join(self, texts: Iterable[list[str]]) -> list[bytes]:
        """Ids of each list of words.

        Words are numbered over all lists, so each distinct one is held and encoded once.
        """
        numbers: defaultdict[str, int] = defaultdict(count().__next__)
        rows = [list(map(numbers.__getitem__, words)) for words in texts]
        words = list(numbers)
        del numbers
        found = list(map(self.kept.get, words))
        unknown = [i for i, ids in enumerate(found) if ids is None]
        for i, ids in zip(unknown, self._encode([words[i] for i in unknown]), strict=True):
            found[i] = ids
        out = [b"".join([found[i] for i in row]) for row in rows]
        if len(self.kept) + len(unknown) <= KEPT_WORDS:
            self._keep(words, found, unknown)
        else:
            self._make_room(words, found, rows)
        return out

    def _keep(self, words: list[str], found: list[bytes], which: list[int]) -> None:
        self.kept.update((words[i], found[i]) for i in which if len(words[i]) <= KEPT_LENGTH)

    def _make_room(self, words: list[str], found: list[bytes], rows: list[list[int]]) -> None:
        """Makes an eighth free: repeated words stay, the most frequent first, then
        those kept before. Words met once would push them out.
        """
        most, before = KEPT_WORDS - KEPT_WORDS // 8, self.kept
        counts = np.bincount(np.fromiter(chain.from_iterable(rows), "i8"))
        order = np.argsort(-counts, kind="stable")[: min(most, np.count_nonzero(counts > 1))]
        self.kept = {}
        self._keep(words, found, order.tolist())
        for word, ids in before.items():
            if len(self.kept) >= most:
                break
            self.kept[word] = ids


class Tokenizer:
    """Encoding and decoding of whole texts as a byte-level vocabulary file says.

    Strings of added tokens in a text become their ids first; the rest is parted
    by the pattern and every part goes through the automaton. Decoding joins the
    labels of the arcs and reads them as UTF-8.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            data = json.load(file)
        model, before = data["model"], data["pre_tokenizer"]
        plain = (
            model["type"] == "BPE"
            and before["type"] == "ByteLevel"
            and not before["add_prefix_space"]
            and data["normalizer"] is None
            and not model.get("ignore_merges")
        )
        if not plain:
            raise ValueError(f"{path} is not a plain byte-level vocabulary")
        letters = byte_letters()

        def raw(token: str) -> bytes:
            return bytes(letters[c] for c in token)

        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        added = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        vocabulary = {raw(t): i for t, i in model["vocab"].items() if t not in added}
        self.automaton = Automaton(vocabulary, [(raw(a), raw(b)) for a, b in pairs])
        self.label = dict(self.automaton.label)
        self.label.update({i: t.encode() for t, i in added.items()})
        longest = sorted(added, key=len, reverse=True)
        self.cut = regex.compile("|".join(map(regex.escape, longest))) if added else None
        self.split = regex.compile(PATTERN).findall
        self.words = Words(self.automaton, added)

    def _parts(self, text: str) -> list[str]:
        """Words of the text and strings of added tokens, in order."""
        if not self.cut or not self.cut.search(text):
            return self.split(text)
        out, start = [], 0
        for match in self.cut.finditer(text):
            out += self.split(text[start : match.start()])
            out.append(match[0])
            start = match.end()
        return out + self.split(text[start:])

    def packed(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        group: list[str] = []
        size = 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= TOGETHER:
                yield from self.words.join(map(self._parts, group))
                group, size = [], 0
        yield from self.words.join(map(self._parts, group))

    def encode(self, text: str) -> list[int]:
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str]) -> Iterator[list[int]]:
        return (np.frombuffer(packed, "<u4").tolist() for packed in self.packed(texts))

    def decode(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are no UTF-8 become replacement characters."""
        label = self.label
        return b"".join([label[i] for i in ids]).decode("utf-8", "replace")


_made: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a vocabulary file, built once in each process."""
    if path not in _made:
        _made[path] = Tokenizer(path)
    return _made[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encode_column(
    docs: DataFrame, text: str = "text", out: str = "ids", path: str | None = None
) -> DataFrame:
    """``docs`` with the ids of each whole text; null counts as empty, giving none.

    The vocabulary file must be at the same place on all machines.
    """
    path = path or default_path()

    def make() -> Callable:
        encode_all = tokenizer(path).encode_all
        return lambda texts: [list(encode_all(t or "" for t in texts))]

    return map_columns(docs, [text], f"{out} ARRAY<INT>", make)


def decode_column(
    docs: DataFrame, ids: str = "ids", out: str = "text", path: str | None = None
) -> DataFrame:
    """``docs`` with the text of each list of ids; null counts as an empty list."""
    path = path or default_path()

    def make() -> Callable:
        decode = tokenizer(path).decode
        return lambda lists: [[decode(x or []) for x in lists]]

    return map_columns(docs, [ids], f"{out} STRING", make)


def round_trip(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` with n_tokens, ids_sha256 and decoded_sha256 of each whole text.

    One pass encodes the text and decodes the ids again, keeping only digests:
    of the ids as little-endian unsigned 32-bit integers and of the decoded text
    in UTF-8. Null counts as empty; repeated rows are kept.
    """
    path = path or default_path()

    def make() -> Callable:
        own = tokenizer(path)

        def digest(texts: list) -> list:
            counts, ids, decoded = [], [], []
            for packed in own.packed(t or "" for t in texts):
                back = own.decode(np.frombuffer(packed, "<u4").tolist())
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                decoded.append(hashlib.sha256(back.encode("utf-8")).hexdigest())
            return [counts, ids, decoded]

        return digest

    return map_columns(
        docs, [text], "n_tokens LONG, ids_sha256 STRING, decoded_sha256 STRING", make
    )
