"""The word vocabulary over all of Unicode, and secrets in more kinds of syntax."""

import random
import re
import subprocess
import sys
import time
from pathlib import Path

import pytest
from tokenizers import Tokenizer

from lakesteps.llm import bpe, secret_scan


@pytest.fixture(scope="module")
def both():
    library = Tokenizer.from_file(bpe.vocabulary_path())
    library.no_truncation()
    library.no_padding()
    return bpe.load(bpe.vocabulary_path()), library


def test_every_code_point_is_cut_as_the_library_cuts_it(both):
    """Each beside letters, digits and signs, so that its class shows."""
    own, library = both
    signs = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{c}b{c}1{c}! {c}\n" for c in signs[i:i + 50]) for i in range(0, len(signs), 50)]
    off = [t for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False)) if own.encode(t) != e.ids]
    assert not off, f"{len(off)} of {len(texts)}, first {off[0][:40]!r}"


def test_random_texts_of_all_code_points(both):
    own, library = both
    rnd = random.Random(6)
    draw = lambda: chr(rnd.choice([rnd.randrange(32, 0x3000), rnd.randrange(0xE000, 0x110000), rnd.randrange(97, 122)]))
    texts = ["".join(draw() for _ in range(rnd.randrange(40))) for _ in range(4000)]
    assert [own.encode(t) for t in texts] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_loading_the_vocabulary_takes_little_memory():
    """Each Python worker loads it, so what that takes for a moment counts as often as there are cores."""
    repo = Path(__file__).resolve().parents[2]
    out = subprocess.run([sys.executable, "-c", """if True:
        from lakesteps.llm import bpe
        import tokenizers
        most = lambda: open("/proc/self/status").read().split("VmHWM:")[1].split()[0]
        before = most()
        bpe.load(bpe.vocabulary_path())
        print(before, most())"""], cwd=repo, capture_output=True, text=True, check=True).stdout
    before, after = map(int, re.findall(r"\d+", out))
    assert (after - before) / 1024 < 200


def test_known_words_are_bounded_by_their_characters(monkeypatch):
    """Texts without white space are one word each."""
    monkeypatch.setattr(bpe, "HELD", 1000)
    known = bpe._Known(lambda w: w.upper())
    for i in range(100):
        assert known[f"{i:0300}"] == f"{i:0300}".upper()
        assert sum(len(k) + len(v) for k, v in known.items()) <= 1600


@pytest.mark.parametrize("text,found", [
    ('a = b = "Xy9$kLm2pQ"; password = a', ["Xy9$kLm2pQ"]), ('dbPassword = other = "Xy9$kLm2pQ"', ["Xy9$kLm2pQ"]),
    ('password=x="Xy9$kLm2pQ"', ["Xy9$kLm2pQ"]), ("const secret = `Xy9$kLm2pQ`", ["Xy9$kLm2pQ"]),
    ('<add key="password" value="Xy9$kLm2pQ1"/>', ["Xy9$kLm2pQ1"]), ('define("DB_PASSWORD", "Xy9$kLm2pQ1");', ["Xy9$kLm2pQ1"]),
    ('conf.put("token", "abcDEF123456")', ["abcDEF123456"]), ("token=abcd1234=", ["abcd1234="]),
    ('<add key="title" value="Xy9$kLm2pQ1"/>', []), ('f("a password", "of some words")', []), ('g("page", "Xy9$kLm2pQ1")', []),
])
def test_pairs_of_name_and_literal(text, found):
    assert [text[s:e] for s, e in secret_scan.literals(text)] == found


@pytest.mark.parametrize("body", [
    'password = "abcdefgh1"' + " " * 1_000_000, 'password = "a1b2c3d4e5"' + " +" * 500_000, "password = " * 90_000,
    'key="password"' + "\n" * 1_000_000, '("' * 500_000, "a = b = " * 120_000, "a." * 500_000, "password" + " " * 1_000_000])
def test_long_texts_take_linear_time(body):
    start = time.perf_counter()
    secret_scan.scan(body)
    assert time.perf_counter() - start < 5
