"""Byte-pair encoding and decoding with a contiguous rank array.

A word is held as its part boundaries and the rank of each pair of neighbours. The smallest rank
is found by a scan, its boundary deleted and the two ranks beside it refreshed, until no pair can
merge. Words repeat, so their results are kept in a bounded table per Python worker.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from functools import lru_cache

import regex
from pyspark.sql import DataFrame, functions as F

from lakesteps.llm.common import free_name, per_text, text_or_empty

#: Words longer than this use a heap instead of scans.
SHORT = 128
#: Entries, and characters in them, of a table of known words before it is emptied.
KNOWN, HELD = 300_000, 16 << 20
#: Code points whose classes are compared at once.
SIGNS = 1 << 13
NEVER = 1 << 60
#: White space of the pre-tokeniser; str.split() also splits at these four control characters.
GAP = regex.compile(r"\p{White_Space}+")
NOT_GAPS = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself, or the next one from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def unlike_signs() -> tuple[dict[int, str], dict[int, str]]:
    """Where the Unicode versions used here and by the library differ.

    Code points whose class differs, each with a sign that has the class it has there; and code
    points that only the library puts in lower case. All are asked for, some thousand at a time: the
    library gives an object per sign, which for all of Unicode at once took 550 MB of each worker.
    """
    from tokenizers import Regex, normalizers, pre_tokenizers

    fold = normalizers.Lowercase().normalize_str
    kinds = [(kind, alike, pre_tokenizers.Split(Regex(kind), "removed"))
             for kind, alike in ((r"\p{L}", "a"), (r"\p{N}", "0"), (r"\s", " "))]
    unlike, lower = {}, {}
    for start in range(0, 0x110000, SIGNS):
        signs = "".join(chr(c) for c in range(start, start + SIGNS) if not 0xD800 <= c < 0xE000)
        lines = fold("\n".join(signs.replace("\n", " "))).split("\n")
        lower |= {ord(c): low for c, low in zip(signs, lines) if c != "\n" and low != c == c.lower()}
        rest = set(signs)
        for kind, alike, split in kinds:
            theirs = rest.difference(*(piece for piece, _ in split.pre_tokenize_str(signs)))
            ours = set(regex.findall(kind, signs))
            unlike |= {ord(c): "\u2603" for c in ours - theirs if ord(c) not in unlike}
            unlike |= {ord(c): alike for c in theirs - ours}
    return unlike, lower


def unordered_marks() -> str:
    """Combining marks that the library's normal form leaves where they are, as it takes them for letters."""
    from tokenizers import normalizers

    marks = [chr(c) for c in range(0x110000) if unicodedata.combining(chr(c))]
    # a mark of class 1 goes before one of a higher class, and one of class 1 before an accent
    pairs = [f"a{c}\u0334" if unicodedata.combining(c) > 1 else f"a\u0315{c}" for c in marks]
    formed = normalizers.NFC().normalize_str("\n".join(pairs)).split("\n")
    return "".join(c for c, p, f in zip(marks, pairs, formed)
                   if f == p and unicodedata.normalize("NFC", p) != p)


class _Known(dict):
    """Results by key, worked out when first asked for; emptied at KNOWN entries or HELD characters."""

    def __init__(self, work):
        super().__init__()
        self.work, self.held = work, 0

    def __missing__(self, key):
        value = self.work(key)
        if len(self) >= KNOWN or self.held >= HELD:
            self.clear()
            self.held = 0
        self.held += len(key) + len(value)
        self[key] = value
        return value


class WordBpe:
    """A byte-pair vocabulary with word ends, as its tokenizer file describes it.

    Text is put in NFC and lower case, cut into contractions, runs of letters, single digits and
    runs of other signs, and white space is dropped. Special tokens in a text are kept whole.
    """

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model = spec["model"]
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or model["byte_fallback"]:
            raise ValueError(f"{path}: not a byte-pair vocabulary with word ends")
        self.end = model["end_of_word_suffix"] or ""
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in (self.vocab | self.special).items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.merged: list[int] = []
        for r, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rank[self.vocab[a], self.vocab[b]] = r
            self.merged.append(self.vocab[a + b])
        letters = byte_letters()
        self.inner = [self.vocab.get(c) for c in letters]
        self.last = [self.vocab.get(c + self.end) for c in letters]
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split)
        self.unlike, self.lower = unlike_signs()
        marks = unordered_marks()
        self.marks = regex.compile(f"([{marks}])") if marks else None
        self.first_unlike = chr(min([*self.unlike, *self.lower], default=0x10FFFF))
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
        # Plain strings: unlike lists they cost the garbage collector nothing.
        self.piece_ids = _Known(lambda p: " ".join(map(str, self.merge(p))))
        self.chunk_ids = _Known(self._chunk)
        self.by_text = {str(i): t for i, t in self.token.items()}
        self.chunk_tokens = _Known(
            lambda c: " ".join(map(self.by_text.__getitem__, self.chunk_ids[c].split())))

    def merge(self, piece: str) -> list[int]:
        """Token ids of one piece."""
        data = piece.encode()
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        if len(parts) > SHORT:
            return self._merge_long(parts)
        get = self.rank.get
        ranks = [get(p, NEVER) for p in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            parts[i] = self.merged[low]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = get((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = get((parts[i], parts[i + 1]), NEVER)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same merges from a heap of (rank, place), for words where scans would be slow."""
        n = len(parts)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i) for i, p in enumerate(zip(parts, parts[1:])) if (r := self.rank.get(p)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or self.rank.get((parts[i], parts[j])) != r:
                continue
            parts[i], alive[j], after[i] = self.merged[r], False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n and (s := self.rank.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(heap, (s, a))
        return [p for p, kept in zip(parts, alive) if kept]

    def _chunk(self, chunk: str) -> str:
        # Sigma is lowered letter by letter, without the form for the end of a word.
        if self.marks and max(chunk) >= "\u0300" and self.marks.search(chunk):
            plain = "".join(unicodedata.normalize("NFC", p) for p in self.marks.split(chunk))
        else:
            plain = unicodedata.normalize("NFC", chunk)
        plain = plain.replace("Σ", "σ").lower()
        if max(plain) < self.first_unlike:
            pieces = self.pieces.findall(plain)
        else:  # cut by signs of the library's classes
            plain = plain.translate(self.lower)
            pieces = [plain[m.start():m.end()] for m in self.pieces.finditer(plain.translate(self.unlike))]
        return " ".join(map(self.piece_ids.__getitem__, pieces))

    def _chunks(self, text: str) -> list[str]:
        if any(c in text for c in NOT_GAPS):
            return [c for c in GAP.split(text) if c]
        return text.split()

    def encode_decode(self, text: str) -> tuple[str, str]:
        """Decimal ids joined by a space, and the decoded text."""
        ids, tokens, at = [], [], 0
        for m in self.specials.finditer(text) if "<|" in text else ():
            if chunks := self._chunks(text[at:m.start()]):
                ids.append(" ".join(map(self.chunk_ids.__getitem__, chunks)))
                tokens.append(" ".join(map(self.chunk_tokens.__getitem__, chunks)))
            ids.append(str(self.special[m[0]]))
            tokens.append(m[0])
            at = m.end()
        if chunks := self._chunks(text[at:] if at else text):
            ids.append(" ".join(map(self.chunk_ids.__getitem__, chunks)))
            tokens.append(" ".join(map(self.chunk_tokens.__getitem__, chunks)))
        return " ".join(ids), " ".join(tokens)

    def encode(self, text: str) -> list[int]:
        return [int(i) for i in self.encode_decode(text)[0].split()]

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by a space, as a vocabulary without a decoder gives them."""
        return " ".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the installed package of public tokenizers has the file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _digests(name: str):
    def work(texts: list[str]) -> list[tuple]:
        bpe, out = load(vocabulary_path(name)), []
        for text in texts:
            ids, decoded = bpe.encode_decode(text)
            out.append((ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest()))
        return out

    return work


def encoded_digests(docs: DataFrame, id: str = "doc_id", text: str = "text",
                    name: str = "word_bpe_49k.json") -> DataFrame:
    """One row per row: id, n_tokens, ids_sha256, decoded_sha256.

    Null counts as empty; an empty text has no tokens and the digests of the empty string. Other
    columns are ignored, repeated rows get the same answer each. Nothing is shuffled.
    """
    rows = docs.select(F.col(f"`{id}`"), text_or_empty(text).alias(free_name(docs, "__text")))
    return per_text(rows, _digests(name), "n_tokens long, ids_sha256 string, decoded_sha256 string",
                    rows.columns[1])


def encode(docs: DataFrame, text: str = "text", name: str = "word_bpe_49k.json",
           out: str = "token_ids") -> DataFrame:
    """``docs`` without ``text``, and its token ids as an array ``out`` (replaced if there is one)."""
    if out in docs.columns and out != text:
        docs = docs.drop(out)
    source = free_name(docs, "__text")
    rows = docs.withColumn(source, text_or_empty(text)).drop(text)

    def work(texts: list[str]) -> list[tuple]:
        bpe = load(vocabulary_path(name))
        return [(bpe.encode(t),) for t in texts]

    return per_text(rows, work, f"`{out}` array<int>", source)


def decode(rows: DataFrame, ids: str = "token_ids", name: str = "word_bpe_49k.json",
           out: str = "decoded") -> DataFrame:
    """``rows`` and the decoded text of each array of ids (null: empty)."""
    @F.pandas_udf("string")
    def text_of(column):
        bpe = load(vocabulary_path(name))
        return column.map(lambda x: "" if x is None else bpe.decode([int(i) for i in x]))

    return rows.withColumn(out, text_of(F.col(f"`{ids}`")))
