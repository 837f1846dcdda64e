from __future__ import annotations

import hashlib
import re

import pytest

from tierflow.llm import imatch

TERM = re.compile(imatch.TERM)
SCHEMA = "doc_id long, text string"


def words_of(text):
    return sorted(set(TERM.findall(text.lower())))


def brute(rows, common, rare):
    """Lexicon, fingerprints and edited texts by plain Python; ids must be distinct."""
    texts = {d: t or "" for d, t in rows}
    df = {}
    for t in texts.values():
        for w in words_of(t):
            df[w] = df.get(w, 0) + 1
    n = len(rows)
    lexicon = {w for w, c in df.items() if c * common <= n and c * rare >= n}

    def member(term, k):
        level, i = divmod(k, imatch.EACH)
        digest = hashlib.sha256(f"{level}{term}".encode()).hexdigest()
        return int(digest[4 * i : 4 * i + 4], 16) % (1 << imatch.BITS[level]) == 0

    def of(text):
        out = []
        for k in range(64):
            inside = [w for w in words_of(text) if w in lexicon and member(w, k)]
            out.append(hashlib.md5(" ".join(inside).encode()).hexdigest()[:8] if inside else "")
        return ",".join(out) if any(out) else "=" + hashlib.md5(" ".join(words_of(text)).encode()).hexdigest()

    order = sorted(texts, reverse=True)
    found = {}
    for at, d in enumerate(order):
        t, after = texts[d], texts[order[(at + 1) % len(order)]]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        found[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), of(t), of(edited))
    return found


def got(spark, rows, schema=SCHEMA, **options):
    df = imatch.fingerprinted(spark.createDataFrame(rows, schema), **options)
    assert df.columns == [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    ]
    return df.collect()


@pytest.mark.parametrize("ranges", [1, 3, 50])
def test_equals_brute_force_however_ids_are_cut(spark, ranges):
    rows = [(i * 7 - 50, " ".join(f"w{(i * j) % 23} Ärger{j % 5}" for j in range(i))) for i in range(40)]
    want = brute(rows, 2, 100)
    found = got(spark, rows, common=2, rare=100, ranges=ranges)
    assert {r.doc_id: (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) for r in found} == want
    order = sorted(want, reverse=True)
    follower = dict(zip(order, order[1:] + order[:1], strict=True))
    for r in found:
        same = want[r.doc_id][2] == want[follower[r.doc_id]][2]
        assert 0 <= r.near_next <= 1 and (r.near_next == 1) == same


def test_copies_agree_and_edits_are_closer_than_strangers(spark):
    def text(seed, n):
        return " ".join(f"t{(seed * 7919 + j * 104729) % 400}" for j in range(n))

    rows = [(i, text(i, 30 + i)) for i in range(120)] + [(500 + i, text(7, 60)) for i in range(3)]
    found = {r.doc_id: r for r in got(spark, rows, common=2, rare=200)}
    assert len({found[500 + i].fingerprint for i in range(3)}) == 1
    assert found[502].near_next == found[501].near_next == 1.0
    edited = sum(r.near_edited for r in found.values()) / len(found)
    strangers = sum(r.near_next for d, r in found.items() if d < 120) / 120
    assert edited > strangers


def test_odd_rows(spark):
    long = "lang " * 30_000
    rows = [(None, "a b", 1), (None, None, 2), (3, "", 3), (3, "", 3), (4, long, 5), (4, "x", 5), (9, "😀é", 0)]
    found = got(spark, rows, "doc_id long, text string, range int", ranges=3)
    assert sorted(r.n_chars for r in found) == [0, 0, 0, 1, 2, 3, 150_000]
    assert {(r.doc_id, r.n_chars): r.near_next for r in found}[3, 0] in (0.0, 1.0)
    assert got(spark, [], ranges=3) == []
    alone = got(spark, [(None, "only one")])[0]
    assert alone.near_next == 1.0 and alone.n_chars == 8
    nameless = got(spark, [(None, "b"), (None, "a")])
    assert {r.edited_sha256 for r in nameless} == {hashlib.sha256(t).hexdigest() for t in (b"a", b"b")}


def test_lexicon_goes_by_share_of_documents(spark):
    rows = [(i, f"all rare{i} " + ("half" if i % 2 else "none")) for i in range(16)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert {r.term for r in imatch.lexicon(df, common=2, rare=4).collect()} == {"half", "none"}
