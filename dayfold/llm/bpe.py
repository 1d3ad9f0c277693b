"""Byte-pair encoding by a tokenization automaton.

The automaton reads tokens and accepts exactly the sequences that the merges produce. It starts with one state that
every base symbol leads back to; each merge (u, v) -> uv, in order, is a gadget: the state after u is replaced by a copy
without the step v, and uv may follow wherever u may, leading where v leads. So the state after a token lacks the steps
removed after it, after its right part before the token came to be, after that one's right part, and so on; and a token
can follow a state unless it, or the left part it was made from before it came to be, was removed there. Both are short
chains; steps asked for are kept in a table. A word's encoding is the one accepted path that spells it; every prefix has
one such path too, so a place from which no path leads on is never tried twice. The different words of a slice of texts
are encoded once, and the texts put together from them in arrays.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words kept with their encodings in one task, twice: those met lately, and those met before them. As many chunks are kept.
CACHED_WORDS = 100_000
#: Steps kept in the automaton's table.
CACHED_STEPS = 1_000_000
#: Bytes of text whose chunks are told apart at once, and most rows of them; a longer text is on its own.
SLICE_BYTES = 4 << 20
SLICE_ROWS = 4096


class Recent:
    """Values by key, of which about the last ``most`` to twice as many are kept; ``make`` gives those of a list of new keys."""

    def __init__(self, make, most: int):
        self.make, self.most = make, most
        self.now, self.before = {}, {}

    def __call__(self, keys: list[str]) -> list:
        """The values of ``keys``, which differ."""
        now, before = self.now.get, self.before.get
        found = [now(k) or before(k) for k in keys]
        new = [k for k, value in zip(keys, found, strict=True) if value is None]
        if new:
            made = iter(self.make(new))
            found = [next(made) if value is None else value for value in found]
        if len(self.now) + len(keys) > self.most:
            self.now, self.before = {}, self.now
        self.now.update(zip(keys, found, strict=True))
        return found


class Automaton:
    """Tokenization automaton of merges over symbols."""

    NEVER = 1 << 40

    def __init__(self, merges: list[tuple[str, str]]):
        self.number: dict[str, int] = {}
        self.tokens: list[str] = []
        self.removed: dict[int, int] = {}  # (token, step) as one number: the merge that took the step away
        self.states: list[list[tuple[int, int]]] = []  # after a token: (token whose removals hold, before which merge)
        self.steps: list[list[tuple[int, int]]] = []  # of a token: (token whose removal stops it, up to which merge)
        self.table: dict[int, bool] = {}
        self.made: dict[str, int] = {}
        self.never: set[str] = set()  # what merges would make that find nothing to merge
        self.longest = 1
        for rank, (u, v) in enumerate(merges):
            self._gadget(u, v, rank)
        self.table.clear()

    def _symbol(self, token: str) -> int:
        found = self.number.get(token)
        if found is None:
            found = self.number[token] = len(self.tokens)
            self.tokens.append(token)
            self.states.append([(found, self.NEVER)])
            self.steps.append([(found, self.NEVER)])
        return found

    def _gadget(self, u: str, v: str, rank: int) -> None:
        if u + v in self.made:
            raise ValueError(f"two merges make {u + v!r}: an encoding would not be unique")
        if u in self.never or v in self.never or not self.step(self._symbol(u), self._symbol(v)):
            self.never.add(u + v)  # v never stands after u: earlier merges take one of them away
            return
        a, b = self._symbol(u), self._symbol(v)
        self.never.discard(u + v)
        self.removed[a << 32 | b] = rank
        made = self._symbol(u + v)
        self.states[made] += [(x, min(before, rank)) for x, before in self.states[b]]
        self.steps[made] += [(x, min(upto, rank)) for x, upto in self.steps[a]]
        self.made[u + v] = made
        self.longest = max(self.longest, len(u + v))

    def step(self, after: int, token: int) -> bool:
        """May ``token`` follow in the state after another one?"""
        key = after << 32 | token
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= CACHED_STEPS:
                self.table.clear()
            known = self.table[key] = self._allowed(after, token)
        return known

    def _allowed(self, after: int, token: int) -> bool:
        rank_of = self.removed.get
        for x, before in self.states[after]:
            for y, upto in self.steps[token]:
                rank = rank_of(x << 32 | y)
                if rank is not None and rank < before and rank <= upto:
                    return False
        return True

    def encode(self, symbols: list[str]) -> list[str]:
        """The accepted token path that spells ``symbols``: the longest step that the state allows, and a shorter one where
        no path leads on. A place that leads nowhere is left out from then on, as only one path leads to it."""
        n, text = len(symbols), "".join(symbols)
        if text in self.made or n == 1:
            return [text]
        made, table, number, longest = self.made.get, self.table.get, self.number.get, self.longest
        path: list[int] = []
        starts: list[int] = []
        dead: set[int] = set()
        place, upto = 0, n
        while place < n:
            after = path[-1] if path else None
            for end in range(min(upto, place + longest), place, -1):
                if end in dead:
                    continue
                piece = text[place:end] if end < n else text[place:]
                token = made(piece) if end > place + 1 else number(piece)
                if token is None:
                    if end > place + 1:
                        continue
                    token = self._symbol(piece)
                if after is None:
                    break
                known = table(after << 32 | token)
                if known or known is None and self.step(after, token):
                    break
            else:
                if not path:
                    raise ValueError("no path spells these symbols")
                dead.add(place)
                upto, place = place - 1, starts.pop()
                path.pop()
                continue
            path.append(token)
            starts.append(place)
            place, upto = end, n
        return [self.tokens[t] for t in path]


@lru_cache(maxsize=4)
def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    odd = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}


class WordTokenizer:
    """Encoder and decoder of a tokenizer file: NFC, white space to one blank, lower case, words by the file's pattern,
    each word's UTF-8 bytes as letters, the last with the end-of-word suffix; no decoder, so tokens join by blanks."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or spec["decoder"]:
            raise ValueError("this tokenizer file has other steps than this encoder")
        self.vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(merges)
        self.suffix = model["end_of_word_suffix"] or ""
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.labels = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.letters = [_byte_letters()[b] for b in range(256)]
        self.spelling = {b: letter for b, letter in enumerate(self.letters)} | {10: self.suffix}  # no word holds a line end
        self.parted = regex.compile(f"{split['pattern']['Regex']}|\\n")
        self.words = Recent(self._words, CACHED_WORDS)
        self.chunks = Recent(self._chunks, CACHED_WORDS)

    def encode_word(self, word: str) -> list[int]:
        symbols = [self.letters[b] for b in word.encode()]
        symbols[-1] += self.suffix
        return [self.vocab[t] for t in self.automaton.encode(symbols)]

    def decode(self, ids: list[int]) -> str:
        """Arc labels of the ids, joined by blanks."""
        return " ".join(self.labels[i] for i in ids)

    def normalized(self, text: str) -> str:
        """NFC and lower case. White space needs no step: the pattern drops it."""
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)  # no final sigma

    def _words(self, words: list[str]) -> list[tuple[int, str, str]]:
        found = []
        for word in words:
            ids = self.encode_word(word)
            found.append((len(ids), " ".join(map(str, ids)), self.decode(ids)))
        return found

    def _chunks(self, chunks: list[str]) -> list[tuple[int, str, str]]:
        """Number of ids, the ids and their labels of what stands between two blanks. The pattern runs over all chunks at
        once; line ends part them, as no chunk holds one."""
        pieces = self.parted.findall(self.normalized("\n".join(chunks)))
        words = [w for w in dict.fromkeys(pieces) if w != "\n"]
        entries = dict(zip(words, self.words(words), strict=True))
        found, own = [], []
        for piece in [*pieces, "\n"]:
            if piece != "\n":
                own.append(entries[piece])
            else:
                found.append(own[0] if len(own) == 1 else (sum([e[0] for e in own]), " ".join([e[1] for e in own]), " ".join([e[2] for e in own])))
                own = []
        return [(1, str(self.special[c]), c) if c in self.special else e for c, e in zip(chunks, found, strict=True)]

    def parts(self, texts: pa.Array) -> tuple[list[tuple[int, str, str]], np.ndarray, np.ndarray]:
        """The entries of all chunks of ``texts`` (NULL: empty), the entry of each chunk that has ids, and where those of
        each text begin and end."""
        texts = pc.fill_null(texts, "")
        if any(pc.any(pc.match_substring(texts, mark)).as_py() for mark in self.special):
            texts = pa.array([self.cut.sub(r" \g<0> ", t) for t in texts.to_pylist()], texts.type)
        pieces = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = pieces.flatten().dictionary_encode()
        entries = self.chunks(coded.dictionary.to_pylist())
        which, bounds = coded.indices.to_numpy(zero_copy_only=False), pieces.offsets.to_numpy(zero_copy_only=False)
        some = np.array([e[0] for e in entries], np.int64)[which] > 0 if entries else np.zeros(0, bool)
        return entries, which[some], np.concatenate([[0], np.cumsum(some)])[bounds - bounds[0]]

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """The ids of each text."""
        entries, which, bounds = self.parts(texts)
        ids = np.array([int(i) for e in entries if e[0] for i in e[1].split(" ")], np.int32)
        counts = np.array([e[0] for e in entries], np.int64)
        first, sizes = np.cumsum(counts) - counts, counts[which]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        values = ids[np.repeat(first[which] - ends[:-1], sizes) + np.arange(ends[-1])]
        return pa.ListArray.from_arrays(pa.array(ends[bounds], pa.int32()), pa.array(values, pa.int32()))

    def written(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Number of ids of each text, its ids and their labels, each joined by blanks."""
        entries, which, bounds = self.parts(texts)
        total = np.concatenate([[0], np.cumsum(np.array([e[0] for e in entries], np.int64)[which])])[bounds]
        starts, blank = pa.array(bounds, pa.int32()), pa.scalar(" ", pa.large_string())
        joined = [pc.binary_join(pa.ListArray.from_arrays(starts, pa.array([e[k] for e in entries], pa.large_string()).take(pa.array(which))), blank) for k in (1, 2)]
        return np.diff(total), *joined

    def spelled(self, text: str) -> str:
        """The byte letters of the words of ``text``, each with its end-of-word mark, and the special tokens between."""
        marks = self.cut.findall(text) if self.cut is not None else []
        found = []
        for plain, mark in zip(self.cut.split(text) if marks else [text], [*marks, ""], strict=True):
            words = "".join([w + "\n" for w in self.pattern.findall(self.normalized(plain))])
            found += [words.encode().decode("latin-1").translate(self.spelling), mark]
        return "".join(found)

    def check(self, text: str, ids: list[int]) -> None:
        """The decoded ids spell the words of ``text``, letter by letter."""
        if "".join([self.labels[i] for i in ids]) != self.spelled(text):
            raise ValueError("ids do not decode to the encoded words")

    def encode(self, text: str) -> list[int]:
        return self.encode_all(pa.array([text])).to_pylist()[0]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> WordTokenizer:
    """The compiled tokenizer of a file, once per Python worker."""
    return WordTokenizer(path)


def _texts(batches):
    """Rows (doc_id, text) in slices of bounded bytes, so that long texts are not all held as Python strings at once."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(sizes), 0
        while at < batch.num_rows:
            before = ends[at] - sizes[at]
            end = min(max(int(np.searchsorted(ends, before + SLICE_BYTES, "right")), at + 1), at + SLICE_ROWS)
            yield batch.slice(at, end - at)
            at = end


def _rows(batches, width: int):
    for batch in batches:
        for at in range(0, batch.num_rows, width):
            yield batch.slice(at, width)


def encode_texts(docs: DataFrame, path: str, verify: bool = False) -> DataFrame:
    """(doc_id, ids) of every whole ``text``; NULL is empty. Rows, repeated ones too, stay one to one.

    ``verify`` decodes what was encoded and fails if the letters of the words do not come back.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches):
        own = tokenizer(path)
        for part in _texts(batches):
            ids = own.encode_all(part.column(1))
            if verify:
                for text, found in zip(part.column(1), ids, strict=True):
                    own.check(text.as_py() or "", found.values.to_pylist())
            yield pa.record_batch([part.column(0).cast(pa.int64()), ids], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id bigint, ids array<int>")


def decode_ids(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids); special tokens are kept. NULL ids decode to an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(batches):
        own = tokenizer(path)
        for part in _rows(batches, 128):
            yield pa.record_batch([part.column(0), pa.array([own.decode(x or []) for x in part.column(1).to_pylist()], pa.string())], schema=schema)

    return encoded.select(F.col("doc_id").cast("bigint"), "ids").mapInArrow(decode, "doc_id bigint, text string")


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them, by document: as ``encode_texts`` and
    ``decode_ids`` give them, from one pass."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])

    def run(batches):
        own = tokenizer(path)
        for part in _texts(batches):
            counts, *written = own.written(part.column(1))
            digests = [pa.array([hashlib.sha256(x.as_buffer()).hexdigest() for x in column], pa.string()) for column in written]
            yield pa.record_batch([part.column(0).cast(pa.int64()), pa.array(counts, pa.int64()), *digests], schema=schema)

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
