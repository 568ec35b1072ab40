"""Operator 4: base spans against plain patterns, and layers that are known."""

import base64
import bz2
import gzip
import hashlib
import random
import re
import urllib.parse
import zlib

import pytest
from bizlens.llm.secret_scan import KINDS, find_secrets, op4_secrets, scan, written

ANY_CASE = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
ASSIGN = re.compile("(" + "|".join(map(ANY_CASE, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
                    + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain(text):
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans():
    rng = random.Random(2)
    parts = ["token", "TOKEN", "passwd", "api_key", "apiKey", "ſecret", "toKen", ":", "=", " ", '"', "'", "abcdef", "1", ".", "AKIA", "ABCD1234", "0123456789abcdef", "é", "\n", "secret", "%41"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert scan(text)[0] == plain(text)


SECRET = 'password = "hunter2hunter2"'
B64 = lambda b: base64.b64encode(b).decode()


@pytest.mark.parametrize("hidden", [
    B64(SECRET.encode()), urllib.parse.quote(SECRET, safe=""), urllib.parse.quote(B64(gzip.compress(SECRET.encode(), mtime=0)), safe=""),
    "".join(f"\\u{ord(c):04x}" for c in SECRET), B64(B64(base64.urlsafe_b64encode(SECRET.encode())).encode()), SECRET.encode().hex(),
    B64(zlib.compress(SECRET.encode())), B64(bz2.compress(SECRET.encode())), B64(urllib.parse.quote(SECRET, safe="").encode())])
def test_layers_map_to_the_text(hidden):
    text = f"é before {hidden} after"
    base, spans, layers = scan(text)
    kind_spans = [(a, b) for a, k, b in spans if KINDS[k] == "assign"]
    assert layers and kind_spans and all(text.index(hidden) <= a < b <= text.index(hidden) + len(hidden) for a, b in kind_spans)
    assert set(base) <= set(spans)


def test_span_within_a_layer():
    text = "see " + urllib.parse.quote('x y AKIA' + "B" * 18 + " é") + " end"
    (a, _, b), = scan(text)[1]
    assert text[a:b] == "AKIA" + "B" * 18


def test_partly_escaped_lines():
    for text in (r"x \u0070assword = \u0022hunter2hunter2\u0022 y", "x %70assword = %22hunter2hunter2%22 y 100%"):
        (a, k, b), = scan(text)[1]
        assert KINDS[k] == "assign" and text[a:b].startswith(("%70", "\\u0070")) and text[a:b].endswith("hunter2")
    long_run = "%" + "A" * 200_000 + " %41"  # linear in the length of a run
    assert scan(long_run)[1] == []


def test_repeated_layers_end():
    text = B64(("%25" * 40 + " " + B64(b"AKIA" + b"C" * 20)).encode()) + " " + B64(b"AKIA" + b"C" * 20)
    assert scan(text)[2] < 50


@pytest.mark.parametrize("blob", [B64(SECRET.encode()), urllib.parse.quote(SECRET, safe=""), B64(B64(SECRET.encode()).encode()), B64(gzip.compress(SECRET.encode(), mtime=0))])
@pytest.mark.parametrize("between", [" ", "\n", " and once more\n"])
def test_equal_layers_are_reported_at_each_place(blob, between):
    text = between.join([blob] * 3)
    places = {text.index(blob, k * (len(blob) + len(between))) for k in range(3)}
    spans = [(a, b) for a, k, b in scan(text)[1] if KINDS[k] == "assign"]
    if between == "\n" or "%" not in blob:  # a percent-encoded line is one layer
        assert len(spans) == 3
    assert all(any(p <= a < b <= p + len(blob) for a, b in spans) for p in places)


NOISE = random.Random(5).randbytes


@pytest.mark.parametrize("hidden", [
    B64(gzip.compress(b"a b " * 3_000_000 + SECRET.encode() + b" c d" * 900_000, mtime=0)),  # 12 MB before it
    B64(gzip.compress(b"plain words", mtime=0) + gzip.compress(SECRET.encode(), mtime=0)), B64(bz2.compress(b"plain") + bz2.compress(SECRET.encode())),
    base64.encodebytes(b"words of any kind, " * 5 + SECRET.encode()).decode(), base64.encodebytes(gzip.compress(NOISE(90) + SECRET.encode(), mtime=0)).decode(),
    B64(NOISE(5000) + SECRET.encode()), B64(SECRET.encode("utf-16")), B64(SECRET.encode("utf-16-be")), NOISE(30).hex() + SECRET.encode().hex()])
def test_whole_layers(hidden):
    text = f"before {hidden} after"
    spans = [(a, b) for a, k, b in scan(text)[1] if KINDS[k] == "assign"]
    assert spans and all(7 <= a < b <= 7 + len(hidden) for a, b in spans)


def test_query(spark, small_dir, texts):
    got = {r["doc_id"]: r for r in op4_secrets(spark, small_dir).collect()}
    assert len(got) == len(texts)
    for i, t in texts:
        base = plain(t or "")
        assert got[i]["base_sha256"] == hashlib.sha256(written(base).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in KINDS] == [sum(s[1] == k for s in base) for k in range(3)]
        assert set(written(base).split(",")) <= set(got[i]["spans"].split(",")) | {""}


def test_odd_rows(odd, none):
    assert find_secrets(odd).count() == odd.count() and find_secrets(none).count() == 0


BLOBS = [B64(SECRET.encode()), base64.urlsafe_b64encode(gzip.compress(SECRET.encode(), mtime=0)).decode(), B64(bz2.compress(SECRET.encode())),
         B64(zlib.compress(SECRET.encode())), SECRET.encode().hex(), gzip.compress(SECRET.encode(), mtime=0).hex()]


@pytest.mark.parametrize("before", ["a/", "/ab/", "path/", "xy-", "k_", "id", "d", "abc+", "x/y/z/"])
@pytest.mark.parametrize("blob", BLOBS)
def test_glued_blobs_are_found_at_their_place(before, blob):
    text = f"see {before}{blob} end"
    found = [(a, b) for a, k, b in scan(text)[1] if KINDS[k] == "assign"]
    at = text.index(blob)
    assert any(at <= a < b <= at + len(blob) for a, b in found), found


def test_wrapped_blobs_behind_a_prefix():
    blob = B64(b"x" * 40 + SECRET.encode() + b"y" * 30)
    lines = [f"xy-{blob[:60]}", *(blob[k:k + 63] for k in range(60, len(blob), 63))]
    text = "\n".join(lines)
    assert any(KINDS[k] == "assign" for _, k, _ in scan(text)[1])


def every_start(text):
    """Kinds with a finding in base64 or hex read from any character on, and the characters read."""
    out = set()
    for start in range(len(text)):
        run = re.match("[A-Za-z0-9+/_-]*", text[start:])[0].replace("-", "+").replace("_", "/")
        run = run[: len(run) // 4 * 4]
        read = base64.b64decode(run).decode("latin-1")
        out |= {(start + a * 4 // 3, k) for a, k, b in plain_kinds(read)}
        run = re.match("(?:[0-9a-fA-F]{2})*", text[start:])[0]
        out |= {(start + a * 2, k) for a, k, b in plain_kinds(bytes.fromhex(run).decode("latin-1"))}
    return out


def plain_kinds(text):
    return [(a, k, b) for a, k, b in plain(text)]


def test_runs_against_every_start():
    rng = random.Random(7)
    secrets = [SECRET, "AKIA" + "Q7" * 9, "token: abcdef123456", "0123456789abcdef01234567"]
    for _ in range(120):
        parts = []
        for _ in range(rng.randint(1, 4)):
            s = ("pad " * rng.randint(1, 5) + rng.choice(secrets) + " pad" * rng.randint(0, 4)).encode()
            parts += [rng.choice(["", "/", "a/", "id", "k_", "7", "xy-"]), rng.choice([B64(s).rstrip("="), s.hex()]), rng.choice([" ", "/", "\n", "."])]
        text = "".join(parts)
        spans = scan(text)[1]
        for a, k in every_start(text):
            assert any(kind == k and lo <= a + 2 and a <= hi for lo, kind, hi in spans), (text, a, KINDS[k], spans)


def test_a_long_even_stream_is_read_in_bounded_time():
    import time

    data = b"a" * (200 << 20)
    text = "x " + B64(zlib.compress(data, 9)) + " y"
    began = time.perf_counter()
    assert scan(text)[2] >= 1
    assert time.perf_counter() - began < 20
    hidden = B64(zlib.compress(b"\n" * (40 << 20) + SECRET.encode(), 9))
    assert any(KINDS[k] == "assign" for _, k, _ in scan(hidden)[1])


def test_members_of_a_stream_are_read_once():
    member = gzip.compress(SECRET.encode(), mtime=0)
    text = B64(member * 400)
    assert {(a, k, b) for a, k, b in scan(text)[1] if KINDS[k] == "assign"} == {(0, 0, len(text.rstrip("=")))}
