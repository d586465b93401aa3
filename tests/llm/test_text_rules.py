"""Compression bands and personal data, row by row against plain versions."""

import hashlib
import random
import re

import pytest
import zstandard
from conftest_data import DOCS, SF, docs_frame

from segtrace.llm.compression import Bands, keep_quality, quality_rules, repeated_words, text_counts
from segtrace.llm.pii import BASE, automaton, find_spans, join_spans, mask_pii, masked, pii_report
from segtrace.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    words = WORD.findall(text)
    at = {}
    for k in range(len(words) - 7):
        at.setdefault(tuple(words[k : k + 8]), []).append(k)
    repeated = {k + j for places in at.values() if len(places) > 1 for k in places for j in range(8)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(repeated)


@pytest.mark.parametrize("seed", range(30))
def test_counts(seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(["a ", "b ", "é\n", "a b c d e f g h ", "\u00a0", "\x85", "#", "x\ty\r\n", "  ", "\U0001f600 "]) for _ in range(rng.randint(0, 120)))
    assert text_counts(text.encode()) == counts(text)


def test_overlapping_repeats():
    assert repeated_words([b"a"] * 9, 8) == 9 and repeated_words([b"a"] * 8, 8) == 0 and repeated_words([], 8) == 0


def test_quality_table(spark):
    rows = {r.doc_id: r for r in QUERIES["op4_compression_bands"](spark, SF).collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{SF}/labels.parquet").filter("quality = 1").collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        r, want = rows[d.doc_id], counts(d.text or "")
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        if d.doc_id in good and not r.base_failed:
            assert r.kept


def test_bands_reject_both_ends(spark):
    rng = random.Random(1)
    noise = " ".join("".join(chr(rng.randint(33, 126)) for _ in range(9)) for _ in range(300))
    slow = " ".join(f"w{k % 3}{k // 3 % 7}" for k in range(2000))
    prose = spark.read.parquet(f"{SF}/documents.parquet").filter("length(text) > 5000 AND lang = 'en'").first().text
    frame = docs_frame(spark, [(101, noise), (102, slow), (103, prose), *DOCS])
    got = {r.doc_id: r for r in quality_rules(frame, bands=Bands()).collect() if r.doc_id}
    assert not got[101].in_band and not got[102].in_band and got[103].kept
    assert got[4].base_failed and got[4].n_words == 0
    kept = keep_quality(frame)
    assert kept.columns == frame.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == sorted(r.doc_id or 0 for r in quality_rules(frame).filter("kept").collect())
    assert quality_rules(docs_frame(spark, [])).count() == 0


def plain_bands(raw, bands=Bands()):
    """(ratio, chunks, chunks below and above, verdict) of one text, without the operator's code."""
    packer = zstandard.ZstdCompressor(level=3)
    size = lambda x: len(packer.compress(x))
    ratio = size(raw) / len(raw) if raw else 0.0
    pieces = [raw[k : k + bands.chunk] for k in range(0, len(raw), bands.chunk)] if len(raw) >= bands.chunk else []
    if len(pieces) > 1 and len(pieces[-1]) < bands.chunk / 2:
        pieces[-2:] = [pieces[-2] + pieces[-1]]
    low, high = (sum(f(size(p) / len(p)) for p in pieces) for f in (lambda x: x < bands.chunk_band[0], lambda x: x > bands.chunk_band[1]))
    least, most = [(a, b) for n, a, b in bands.whole if len(raw) >= n][-1]
    return ratio, len(pieces), low, high, least <= ratio <= most and low + high <= bands.max_bad_chunks * len(pieces)


def test_ratios_and_bands_again(spark):
    """Every document's ratio, chunks and verdict, computed once more."""
    rows = {r.doc_id: r for r in QUERIES["op4_compression_bands"](spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        r, raw = rows[d.doc_id], (d.text or "").encode()
        assert (r.ratio, r.n_chunks, r.n_chunks_low, r.n_chunks_high, r.in_band) == plain_bands(raw) and r.n_bytes == len(raw)
        assert r.kept == (r.in_band and not r.base_failed)


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(d[::-1])) % 10 == 0


def base(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m)
    out = [f"email:{m.start()}:{m.end()}" for m in EMAIL.finditer(text)]
    out += [f"ip:{m.start()}:{m.end()}" for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [f"card:{m.start()}:{m.end()}" for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [f"phone:{m.start()}:{m.end()}" for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return ",".join(out)


@pytest.mark.parametrize("seed", range(60))
def test_base_spans(seed):
    rng = random.Random(seed)
    parts = ["a", "b.c", "@", "x@y.z", "@d.e", ".", "-", " ", "+1", "+", "(5)", "123", "4111 1111 1111 1111", "1.2.3.4", "256.1.1.1", "é", "İ", "://", "token = ", "\n", "0", "001.02.3.4", "+49 30 1234567", "%"]
    text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))
    assert join_spans(find_spans(text, automaton()), BASE) == base(text)


LOCAL = "[A-Za-z0-9._%+-]"
SPACE = "\x20"
MORE = {
    "secret": [rf"(?i:api_key|api-key|apikey|access_key|auth_token|secret|token)[\"']?{SPACE}?(?:=>|[:=]){SPACE}?[\"']?([A-Za-z0-9_\-./+]{{16,}})",
               rf"(?i:password|passwd|passwort|mot de passe|contraseña)[\"']?{SPACE}?(?:=>|[:=]){SPACE}?(?:\"([^\"\s]{{6,}})\"|'([^'\s]{{6,}})'|([^\s\"']{{6,}}))"],
    "login": [r"://([^\s/?#@:\"'<>]+:[^\s/?#@\"'<>]+)(?=@[A-Za-z0-9])"],
    "account": [rf"(?i:account number|account no|acct no|acct|kontonummer|numéro de compte|número de cuenta|passport no|passport number|ssn)\.?[:#={SPACE}]{{1,3}}([0-9](?:[{SPACE}-]?[0-9]){{5,19}})(?![0-9])"],
}


def further(text, kind):
    """Spans of a further kind by plain search at every place."""
    out = []
    for pattern in MORE[kind]:
        for k in range(len(text)):
            if m := re.compile(pattern).match(text, k):
                out.append(next(m.span(g) for g in range(1, m.re.groups + 1) if m[g] is not None))
    return out


def test_further_spans_again(spark):
    """Whatever a plain search finds for secret, login and account is in some span of the kind, and each span is found by it."""
    for d in spark.read.parquet(f"{SF}/documents.parquet").limit(120).collect():
        spans = find_spans(d.text or "", automaton())
        for kind in MORE:
            want = further(d.text or "", kind)
            assert set(spans[kind]) <= set(want)
            assert all(any(a < y and x < b for x, y in spans[kind]) for a, b in want), (d.doc_id, kind)


@pytest.mark.parametrize(("text", "kind", "piece"), [
    ("password: hunter2!", "secret", "hunter2!"), ("passwd='a b c' password=\"s3cr3t\"", "secret", "s3cr3t"), ("please transfer it to DE89 3704 0044 0532 0130 00 today", "iban", "DE89 3704 0044 0532 0130 00"),
    ("IBANs: GB29NWBK60161331926819.", "iban", "GB29NWBK60161331926819"), ("to DE88 3704 0044 0532 0130 00 today", "iban", None), ("xDE89370400440532013000", "iban", None), ("password: none", "secret", None),
])
def test_anchored_without_cue(text, kind, piece):
    assert [text[a:b] for a, b in find_spans(text, automaton())[kind]] == ([piece] if piece else [])


def test_pii_table(spark):
    rows = {r.doc_id: r for r in QUERIES["op9_pii"](spark, SF).collect()}
    for d in spark.read.parquet(f"{SF}/documents.parquet").collect():
        want = base(d.text or "")
        assert rows[d.doc_id].base_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert set(filter(None, want.split(","))) <= set(rows[d.doc_id].spans.split(","))


def test_further_kinds_and_mask(spark):
    text = 'api_key = "A1b2C3d4E5f6G7h8I9" and IBAN: DE89 3704 0044 0532 0130 00, see ftp://bob:pw@h.example/x; account no. 12345678 mail a@b.de'
    spans = find_spans(text, automaton())
    assert [len(spans[k]) for k in ("secret", "iban", "login", "account", "email")] == [1, 1, 1, 1, 2]
    safe = masked(text, spans)
    assert not any(x in safe for x in ("A1b2", "DE89", "bob", "pw", "12345678", "a@b.de")) and "<SECRET>" in safe and "<EMAIL>" in safe
    frame = docs_frame(spark, [*DOCS, (20, text)])
    out = mask_pii(frame)
    assert out.columns == frame.columns and {r.text for r in out.collect() if r.doc_id == 20} == {safe} and out.filter("text IS NULL").count() == 2
    got = {r.doc_id: r for r in pii_report(frame).collect()}
    assert got[3].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert pii_report(docs_frame(spark, [])).count() == 0
