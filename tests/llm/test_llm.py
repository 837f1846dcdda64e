"""The training-data operators against plain Python on small inputs."""

from __future__ import annotations

import collections
import functools
import hashlib
import math
import random
import re
import tempfile
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_queries import compare
from tierflow.llm import (
    bpe, chat, ctw, decontamination, html, jaccard, licences, ranking, rules, tokens, workload,
)
from tierflow.llm.pieces import pieces_of

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, words int"
LONG = "Quite a long line of words that ends well, as lines do. " * 400
ODD = [
    (1, None), (2, ""), (3, LONG), (3, LONG), (None, "one two three four five six."),
    (4, "no break " * 3), (5, " \n\t\r\n"), (6, "Ünïcode wörds ÉTÉ <|endoftext|> x<|startoftext|>y  z"),
    (7, "x" * 3000), (8, "a\\b [INST] <s>\n\nmenu | home | about |\nThe End."),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", 1) for i, t in ODD], DOCS).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", sorted(workload.ORACLES))
def test_query_matches_sql(spark, name):
    good, note = compare(spark, SF, workload.QUERIES[name], workload.ORACLES[name])
    assert good, note


def test_turns_come_back_and_losses_are_counted_once(spark):
    text = "</s>[INST] ok [/INST] [\\INST] \\<\\s>"
    random.seed(5)
    rows = [(c, t, role, text + " word" * random.randint(0, 300)) for c in (1, None) for t, role in
            enumerate(["system", *["user", "assistant"] * 40])]
    rows += [(2, 0, None, None), (2, 0, "tool ]x", "same"), (2, 0, "tool ]x", "same"), (3, None, "assistant", "w " * 3000)]
    turns = spark.createDataFrame([(*r, 1, 2) for r in rows], "conv_id long, turn long, role string, text string, tokens int, cell int")
    made = chat.windows(turns, budget=256, history=64)
    per_conv = collections.defaultdict(list)
    for r in rows:
        per_conv[r[0]].append((r[1] if r[1] is not None else -1, r[2] or "", r[3] or ""))
    for r in chat.read_back(made).collect():
        want = sorted(per_conv[r.conv_id])
        assert r.n_turns == len(want)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in want).encode()).hexdigest()
        loss = "".join(b for _, a, b in want if a == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert made.where("conv_id = 1").count() > 20
    assert made.where("conv_id = 1 and window > 1 and not startswith(formatted, '[SYS]')").count() == 0
    assert chat.windows(turns.limit(0)).count() == 0


def turns_of(formatted):
    return re.findall(r".*?(?:</s>|\[/INST\]|\[/SYS\])", formatted, re.S)


def tokens_of(formatted):
    parts = turns_of(formatted)
    return sum(len(re.findall(r"[^\x20\x09-\x0D]+", re.sub(r"^\[(INST|SYS)\] | \[/(INST|SYS)\]$|</s>$", "", p))) + chat.TURN_COST for p in parts)


@pytest.mark.parametrize("system", [0, 100, 500, 900])
def test_windows_keep_the_budget_and_the_latest_system_turn(spark, system):
    rng = random.Random(system)
    rows = [(1, 0, "system", "s0 " + "w " * system)]
    for t in range(1, 400):
        role = "system" if t in (97, 98, 300) else rng.choice(["user", "assistant"])
        rows.append((1, t, role, f"s{t} " + "w " * min(system // 2, 50) if role == "system" else "x " * rng.randint(0, 60)))
    made = chat.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    found = made.orderBy("window").collect()
    assert max(tokens_of(r.formatted) for r in found) <= chat.BUDGET
    latest, turn = None, 0
    for r in found:
        own = turns_of(r.formatted)
        if latest is not None:
            assert own[0].startswith(f"[SYS] s{latest} "), (own[0][:20], latest)
        for p in own[r.n_repeated :]:
            if p.startswith("[SYS] s"):
                latest = int(re.match(r"\[SYS\] s(\d+)", p)[1])
            turn += 1
    assert turn == len(rows)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<p>", ""), ("plain &amp; simple", "plain & simple"),
        ("<body><div class='side-bar menu'><a href=x>home</a></div><div id=content><p>First, of all, this is a long paragraph.</p>"
         "<p>Short.</p><ul><li>one<li>two</ul></div><div class=comments><p>A reader, who comments at length, is not wanted.</p></div>",
         "First, of all, this is a long paragraph. Short. one two"),
        ("<body><nav><a href=x>home</a></nav><div><div class=lead>A lead of few words</div>bare text<h4>Part</h4><div><p>"
         + "The body, which is long, has commas, and more. " * 3 + "</p></div><dl><dt>term<dd>meaning</dl><table><tr><td>1<td>2"
         "</table><div><a href=1>next story</a> <a href=2>more</a></div><p>The end.</p><div class=newsletter>sign</div></div>",
         "A lead of few words bare text Part " + "The body, which is long, has commas, and more. " * 3
         + "term meaning 1 2 The end."),
        ("<article><p>one <svg/> two</p><p class=share-price>three</p><p class=share-bar>four</p><p class='x share'>five</p></article>",
         "one two three"),
        ("<header>Site</header><main><header><h1>Title</h1></header><section><p>aa&nbsp;bb\n cc&#33;</p></section><aside>no</aside>"
         "<form><input>no</form><p>x<script>1<2</script>y</main><footer>f</footer>", "Title aa bb cc! xy"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_deep_and_long_pages_do_not_crash():
    assert html.main_text("<div>" * 5000 + "text" + "</div>" * 10) == "text"
    assert len(html.main_text("<article><p>" + "word " * 200_000)) == 200_000 * 5 - 1


def test_rules_on_odd_rows(spark, odd, none):
    got = rules.quality_figures(odd).collect()
    assert len(got) == len(ODD) and rules.quality_figures(none).count() == 0
    for (_, t), r in zip(ODD, got, strict=True):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        grams = collections.Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {p + k for p in range(len(w) - 2) if grams[tuple(w[p : p + 3])] > 1 for k in range(3)}
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(w), sum(map(len, w)), len(covered))


def test_prose_with_an_unfinished_end_stays(spark):
    sentence = "The river turns, and the old road follows it down to the harbour. "
    menu = "Home News Sport Culture Travel Weather Video Archive Contact"
    rows = [
        (1, sentence * 8 + "and then at 14 Mill Lane"), (2, (sentence * 3 + "it ends with no mark\n") * 4),
        (3, (menu + "\n") * 7 + sentence * 2), (4, "\n".join(f"{menu} {i}" for i in range(9))),
        (5, ("a b c | d e f | g h i | j, k l m | n o p\n") * 6 + "end"),
    ]
    got = rules.quality_figures(spark.createDataFrame(rows, "doc_id long, text string"))
    good = spark.createDataFrame(rows, "doc_id long, text string").select(
        "doc_id", rules.loses_little(F.col("text"), rules.word_chars(F.col("text"))).alias("good")
    )
    assert {r.doc_id: r.good for r in good.collect()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert got.count() == 5


def test_failed_lines_are_removed(spark):
    text = "A fine line of text.\nhome | about | news | more\nEnable JavaScript to go on.\nSTOP!! IT!! NOW!!\nok# $# *# %#.\nEnd."
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(rules.cleaned(F.col("t"))).first()[0] == "A fine line of text.\nEnd."


def distance(pattern: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        old, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            old, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, old + (p != t))
    return min(row)


def test_myers_matches_the_table():
    random.seed(3)
    for _ in range(200):
        p = bytes(random.choices(b"abc", k=random.randint(1, 90)))
        t = bytes(random.choices(b"abc", k=random.randint(0, 120)))
        assert decontamination.myers(p, t, 500) == distance(p, t)


def test_edited_items_are_found(spark, odd, none):
    random.seed(4)
    item = " ".join("".join(random.choices("abcdefgh", k=5)) for _ in range(40))
    edited = item[:50] + "zz" + item[53:120] + item[121:200].upper() + "!" + item[201:]
    far = "".join("z" if i % 8 == 0 else c for i, c in enumerate(item))
    docs = spark.createDataFrame([(1, "x " + edited + " y"), (2, far), (3, f"so {item}"), (4, None)], "doc_id long, text string")
    items = spark.createDataFrame([(9, item), (10, None), (11, " ")], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.n_edits for r in decontamination.contaminated(docs, items).collect()}
    body = decontamination.normal(edited)
    assert found == {(1, 9): distance(decontamination.normal(item), body), (3, 9): 0}
    assert decontamination.contaminated(docs, items, block_bytes=16).count() == 2
    assert {r.doc_id for r in decontamination.without_contaminated(docs, items).collect()} == {2, 4}
    assert decontamination.contaminated(none, items).count() == decontamination.contaminated(odd, items.limit(0)).count() == 0


def test_ranking_separates_held_out_rows(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = ranking.ranked(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) > 0.95 * len(got)
    assert ranking.ranked(odd, labels).count() == len(ODD) and ranking.ranked(none, labels).count() == 0
    alone = ranking.ranked(odd, labels.limit(0)).collect()
    assert {(r.score, r.predicted) for r in alone} == {(0.5, 1)}


def plain_features(text):
    """The nine numbers of a text, character by character."""
    text = text or ""
    own = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not own:
        return [0.0] * 9
    chars = len(text) - len(re.findall(r"[\x20\x09-\x0D]", text))
    count = lambda kinds: sum(text.count(c) for c in kinds)
    capitals = sum("A" <= c <= "Z" or "\xc0" <= c <= "\xde" for c in text)
    windows = [tuple(own[i : i + 3]) for i in range(max(len(own) - 2, 1))]
    n = len(own)
    found = [
        count("#*$%&<>|") * 5 / chars, count("|") * 5 / n, count("!") * 2 / n, capitals * 3 / chars,
        sum(c in "0123456789" for c in text) * 2 / chars, count(".,;:?") * 3 / n,
        (len(windows) - len(set(windows))) * 3 / n, chars / (n * 16), 1.0,
    ]
    return [min(x, 1.0) for x in found]


def test_features_match_plain_counts():
    rng = random.Random(2)
    texts = ["", None, " \n", "A", "Ünï ÄÖ!", "a b c a b c a b c"]
    texts += ["".join(rng.choices("aB1 .,!|#é\n ", k=rng.randint(1, 200))) for _ in range(200)]
    assert ranking.features(texts) == pytest.approx(np.array([plain_features(t) for t in texts]))


def test_threshold_is_that_of_all_labelled_rows(spark):
    """The cut does not move with the bound of the sample that the weights come from."""
    rows = [(i, ("good plain words here. " * 9 if i % 3 else "BAD! | # $ | !! ") * (1 + i % 5)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in rows], "doc_id long, quality int")
    x = spark.createDataFrame([(i, [float(v) for v in f]) for (i, t), f in zip(rows, ranking.features([t for _, t in rows]), strict=True)], "id long, x array<double>")
    known = x.join(labels.withColumnsRenamed({"doc_id": "id", "quality": "label"}), "id")
    for bound in (40, 1000):
        model = ranking.learn(docs, labels, sample_rows=bound)
        centre, spread, weights = map(np.array, (model.centre, model.spread, model.weights))
        own = [(float(((np.array(r["x"]) - centre) / spread) @ weights), r["label"]) for r in known.collect()
               if zlib.crc32(str(r["id"]).encode()) % 3 != 1]
        bad = sum(label == 0 for _, label in own)
        assert model.cut == pytest.approx(sorted(s for s, _ in own)[bad - 1])
        assert ranking.ranked(docs, labels, sample_rows=bound).where("doc_id % 3 > 0 and predicted = 0").count() == 0


def shingled(text):
    w = tuple((text or "").encode().lower().split())
    return w, {w[i : i + 5] for i in range(len(w) - 4)} or ({w} if w else set())


def test_jaccard_links_match_brute_force(spark, odd, none, monkeypatch):
    random.seed(8)
    base = ["".join(random.choices("abcdef", k=4)) for _ in range(120)]
    rows = list(ODD)
    for i in range(60):
        w = list(base)
        for _ in range(random.randint(0, 3)):
            w[random.randrange(len(w))] = f"new{i}"
        rows.append((100 + i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    by_words = collections.defaultdict(list)
    for i, t in rows:
        by_words[shingled(t)[0]].append(i)
    sets = {w: shingled(b" ".join(w).decode())[1] for w in by_words}
    links = {a: sum(a != b and len(x & y) >= 0.8 * len(x | y) for b, y in sets.items() if x and y) for a, x in sets.items()}
    for block in (jaccard.BLOCK, 16):
        monkeypatch.setattr(jaccard.bucketed, "__defaults__", (block,))
        got = jaccard.near_duplicates(docs).collect()
        assert len(got) == len(rows)
        text = dict(rows)
        for r in got:
            own = shingled(text[r.doc_id])[0]
            assert (r.n_links, r.n_copies) == (links[own], len(by_words[own]))
    assert jaccard.near_duplicates(none).count() == 0
    kept = jaccard.one_of_each(docs).collect()
    assert len(kept) == len({r.group_id for r in got if r.group_id is not None}) + 1


def test_codes_give_every_id():
    for high in (2, 200, 60_000, 2**32):
        ids = np.random.default_rng(1).integers(0, high, 3000, dtype=np.uint64).astype(np.uint32)
        codes = tokens.Codes(tokens.pack(ids))
        assert (codes.read(0, 3000) == ids).all() and (codes.read(1021, 2049) == ids[1021:2049]).all()
        assert [codes[i] for i in range(0, 3000, 7)] == ids[::7].tolist()


def test_words_are_encoded_as_the_library_does():
    words = tokens.Words(public_tokenizers.path("byte_bpe_50k.json"), most=300)
    tok = pieces_of(public_tokenizers.path("byte_bpe_50k.json")).tokenizer
    rng = random.Random(4)
    parts = [
        "Word", "été", " ", "  ", "\n", ".", "!!", "(x)", "-", "a.\nB", "#", "?!", '"', "<", "|", "é", "“", "\xa0", "\u3000",
        "1", "'s", "don't", "<|endoftext|>", "😀", "_", "\u0301", "²", "日本", "ǅ", "ª", "Ġ", "x" * 300,
    ]
    texts = ["", " ", "  a", "a  b", " lead", "trail ", "\n\nx y\n\n", "A.\n\nB c"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 30))) for _ in range(2000)]
    for start in range(0, len(texts), 50):
        part = texts[start : start + 50]
        for text, ids in zip(part, tokens.token_ids(words, part), strict=True):
            assert ids.tolist() == [*tok.encode(text, add_special_tokens=False).ids, tokens.END], text


def test_words_that_come_again_are_encoded_once():
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = tokens.Words(path, most=1000)
    library, given = words.tokenizer, []

    class Counted:
        def encode(self, text, **how):
            return self.encode_batch_fast([text], **how)[0]

        def encode_batch_fast(self, texts, **how):
            given.extend(w for t in texts for w in t.split())
            return library.encode_batch_fast(texts, **how)

    words.tokenizer = Counted()
    common, rare = [f"common{i}x" for i in range(100)], [f"rare{i}x" for i in range(6000)]
    for start in range(0, len(rare), 400):  # rare words alone fill the cache several times
        text = ". " + " ".join(common + rare[start : start + 400])
        (ids,) = tokens.token_ids(words, [text])
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, tokens.END]
    counts = collections.Counter(given)
    assert {counts[w] for w in common + rare} == {1}
    assert len(words.kept) + len(words.once) <= 1000
    words.most = 120  # fewer than come again
    for part in (common[:60], common[30:90], common[40:], common) * 3:
        (ids,) = tokens.token_ids(words, [" ".join(part)])
        assert ids.tolist() == [*library.encode(" ".join(part), add_special_tokens=False).ids, tokens.END]


def test_odd_white_space_is_encoded_as_the_library_does():
    path = public_tokenizers.path("byte_bpe_50k.json")
    words, tok = tokens.Words(path), pieces_of(path).tokenizer
    rng = random.Random(5)
    parts = [
        "a", "B", " ", "  ", "\n", "\n\n", " \n", "\n ", "\r\n", "\t", "\0", " \0", "\0s", "\0^", "\x1c", "\x85", "\xa0",
        "<|endoftext|>", "<|", "é", "日本", "“", "\u0301", "1", "'s", ".", ",", ". ", ",\n", "x" * 120,
    ]
    texts = ["a  <|endoftext|>", "a \n<|endoftext|>b", "\n\n<|endoftext|>", "", "\0", " \0", " ", "\n", "\nA", " \nA"]
    texts += ["".join(rng.choices(parts, k=rng.randint(1, 14))) for _ in range(3000)]
    for start in range(0, len(texts), 100):
        part = texts[start : start + 100]
        for text, ids in zip(part, tokens.token_ids(words, part), strict=True):
            assert ids.tolist() == [*tok.encode(text, add_special_tokens=False).ids, tokens.END], text


def test_written_tokens_come_back(spark, odd, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = odd.select("doc_id", "text").unionByName(spark.read.parquet(f"{SF}/documents.parquet").select(F.col("doc_id") + 100, "text").toDF("doc_id", "text"))
    target = tempfile.mkdtemp() + "/t"
    tokens.write(rows, target, path, partitions=3, segment_ids=2000)
    got = sorted(tokens.read(spark, target).collect(), key=lambda r: r.start)
    tok, at = pieces_of(path).tokenizer, 0
    texts = collections.defaultdict(set)
    for r in rows.collect():
        texts[r.doc_id].add(r.text or "")
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in rows.collect()), key=lambda d: -1 if d is None else d)
    for r in got:
        (text,) = texts[r.doc_id]
        ids = tok.encode(text, add_special_tokens=False).ids + [0]
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert tokens.token_at(spark, target, at - 1) == 0
    tokens.write(none, target + "0", path)
    assert tokens.read(spark, target + "0").count() == 0


def test_chunked_encoding_is_exact(spark, odd, none, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(bpe, "BYTES_PER_CUT", 64)  # cuts inside words, so that joins need repair
    monkeypatch.setattr(bpe, "SPACES_PER_CHUNK", 4)
    tok = pieces_of(path).tokenizer
    random.seed(6)
    glued = ["".join(random.choices("abcdéü1,.'", k=4000)), "it's " + "don't'll" * 300 + " End. <|endoftext|>A"]
    coder = bpe.Chunked(pieces_of(path))
    texts = [t or "" for _, t in ODD] + glued
    for text, (ids, decoded) in zip(texts, coder.encode([t.encode() for t in texts]), strict=True):
        want = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == tok.decode(want, skip_special_tokens=False)
    assert coder.repaired
    assert bpe.digests(bpe.encoded(odd, path)).count() == len(ODD) and bpe.encoded(none, path).count() == 0


def test_context_tree_scores(spark, odd, none):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        odd.select((F.col("doc_id") + 10_000).alias("doc_id"), "text")
    )
    got = ctw.scored(docs).collect()
    rows = docs.collect()
    assert len(got) == len(rows) and ctw.scored(none).count() == 0
    seen = collections.Counter()
    for r in rows:
        if not ctw.is_held_out(r.doc_id):
            seen.update([*(r.text or "").encode().lower().split(), None])
    n, v = sum(seen.values()), len(seen)
    text = {r.doc_id: r.text for r in rows}
    for r in got:
        own = [*(text[r.doc_id] or "").encode().lower().split(), None]
        want = sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in own)
        assert r.base_score == pytest.approx(want) and r.n_tokens == len(own) and r.train_tokens == n
        assert r.n_known == sum(seen[w] > 0 for w in own) and r.score < 0
    small = {(r.doc_id, r.n_tokens): r.score for r in ctw.scored(docs, block_grams=9000, head_words=50).collect()}
    assert all(small[r.doc_id, r.n_tokens] == pytest.approx(r.score) for r in got)


def plain_tree(train, depth):
    """Counts of all nodes (context, bits of the byte) and a scorer, by plain recursion."""
    counts = collections.defaultdict(lambda: [0, 0])

    def walk(text):
        full = bytes(depth) + text + ctw.END
        for at in range(depth, len(full)):
            bits = f"{full[at]:08b}"
            for k in range(8):
                yield full[at - depth : at][::-1], bits[:k], int(bits[k])

    for text in train:
        for context, bits, bit in walk(text):
            for d in range(depth + 1):
                counts[context[:d], bits][bit] += 1
    below = collections.defaultdict(set)
    for context, bits in list(counts):
        if context:
            below[context[:-1], bits].add(context)

    def log_e(node):
        a, b = counts.get(node, (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    @functools.cache
    def log_children(context, bits):
        return sum(log_w(c, bits) for c in sorted(below[context, bits]))

    @functools.cache
    def log_w(context, bits):
        if len(context) == depth:
            return log_e((context, bits))
        return math.log(0.5) + float(np.logaddexp(log_e((context, bits)), log_children(context, bits)))

    def predicted(context, bits, bit, d):
        n = counts.get((context[:d], bits), (0, 0))
        own = (n[bit] + 0.5) / (sum(n) + 1)
        if d == depth:
            return own
        share = 1 / (1 + math.exp(log_children(context[:d], bits) - log_e((context[:d], bits))))
        return share * own + (1 - share) * predicted(context, bits, bit, d + 1)

    return lambda text: sum(math.log10(predicted(c, b, x, 0)) for c, b, x in walk(text))


def test_context_tree_score_is_that_of_a_plain_tree(spark):
    rng = random.Random(8)
    words = ["the", "then", "these", "ção", "lore", "lorem", "ab"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(1, 25)))) for i in range(30)] + [(31, None), (None, "The  END")]
    found = ctw.scored(spark.createDataFrame(rows, "doc_id long, text string"), block_grams=150).collect()
    score = plain_tree([ctw.canonical(t) for i, t in rows if not ctw.is_held_out(i)], ctw.DEPTH)
    texts = dict(rows)
    assert len(found) == len(rows) and len({r.held_out for r in found}) == 2
    for r in found:
        assert r.score == pytest.approx(score(ctw.canonical(texts[r.doc_id])), rel=1e-7)


def test_context_tree_gives_code_length_per_byte(odd):
    for r in ctw.scored(odd.where("doc_id <> 3 or doc_id is null")).collect():
        size = len(ctw.canonical(next(t for i, t in ODD if i == r.doc_id))) + 1
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / size)


def test_context_tree_scores_do_not_depend_on_how_a_pass_is_split(spark, odd, monkeypatch):
    whole = {r.doc_id: r.score for r in ctw.scored(odd).collect()}
    real = ctw._pass
    monkeypatch.setattr(ctw, "_pass", lambda rows, *rest: real(rows.repartition(2 + rest[-1], "text"), *rest))
    got = ctw.scored(odd, block_grams=100).collect()
    assert len(got) == len(ODD)
    assert all(r.score == pytest.approx(whole[r.doc_id]) for r in got)


def plain_grams(text):
    full = bytes(ctw.DEPTH) + text + ctw.END
    for at in range(ctw.DEPTH, len(full)):
        yield int.from_bytes(full[at - ctw.DEPTH : at][::-1] + full[at : at + 1], "big")


def test_grams_hold_the_context_newest_first_then_the_byte():
    for texts in ([b""], [b"", b"a", b"", b"abcdefghij", b"\xff\x80\xfe" * 5], [b"abc" * 99, b""]):
        keys, sizes = ctw.grams(texts)
        assert keys.dtype == np.uint64 and keys.tolist() == [k for t in texts for k in plain_grams(t)]
        assert sizes.tolist() == [len(t) + 1 for t in texts]


def test_counts_of_several_parts_are_added_up():
    parts = [([1, 5, 2**63 + 1], [1, 0, 2]), ([5], [7]), ([0, 1], [1, 2**40]), ([2**64 - 1], [3])]
    keys, n = ctw._merged([(np.array(k, np.uint64), np.array(v, np.int64)) for k, v in parts])
    assert keys.tolist() == [0, 1, 5, 2**63 + 1, 2**64 - 1] and n.tolist() == [1, 2**40 + 1, 7, 2, 3]
    assert n.dtype == np.int64


def test_each_gram_of_many_texts_is_looked_up_once(monkeypatch):
    texts = [b"\xff\xfe over and over again", b"", b"over and out", b"\xff\xfe over and over again"] * 50
    every = sorted({k for t in texts for k in plain_grams(t)})
    table = np.array(every[::2], np.uint64)
    values = -np.arange(1.0, len(table) + 1)
    looked_up, real = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, *rest: looked_up.append(len(v)) or real(a, v, *rest))
    sums, sizes = ctw.gram_sums(texts, table, values)
    by_key = dict(zip(table.tolist(), values.tolist(), strict=True))
    assert sums.tolist() == [sum(by_key.get(k, 0) for k in plain_grams(t)) for t in texts]
    assert looked_up == [len(every)] and sizes.tolist() == [len(t) + 1 for t in texts]
    assert not ctw.gram_sums(texts, table[:0], values[:0])[0].any()


def test_no_more_texts_are_looked_up_at_once_than_a_key_can_number():
    found = list(ctw._slices([None] * 200_000 + ["x" * 5_000_000, "y"]))
    assert found[0][0] == 0 and found[-1][1] == 200_002
    assert all(a[1] == b[0] for a, b in zip(found, found[1:], strict=False))
    assert max(j - i for i, j in found) <= 1 << ctw.TEXT_BITS and (200_000, 200_001) in found


def test_words_are_hashed_in_the_first_pass_only(monkeypatch):
    class Rows:
        def select(self, *_):
            return self

        def mapInPandas(self, run, schema):
            return run

    class Shared:
        value = ("some", np.array([1], np.int64), np.array([0.5]))

    import pandas as pd

    hashed, real = [], ctw.word_hashes
    monkeypatch.setattr(ctw, "word_hashes", lambda own: hashed.append(len(own)) or real(own))
    batch = pd.DataFrame({"row": range(5), "doc_id": range(5), "text": [None, "", "a b", "a", "c"]})
    for block, want in ((0, [5]), (1, [5]), (7, [5])):
        found = pd.concat(ctw._pass(Rows(), Shared, Shared, block)(iter([batch.copy()])))
        assert found["row"].tolist() == [*range(5)] and hashed == want
    assert found.columns.tolist() == ["row", "score"]


def test_context_tree_probabilities_sum_to_one():
    keys = np.unique(ctw.grams([b"abracadabra", b"abba"])[0])
    context = keys[3] >> np.uint64(8) << np.uint64(8)
    every = np.unique(np.r_[keys, context | np.arange(256, dtype=np.uint64)])
    n = np.isin(every, keys).astype(np.int64)
    import pandas as pd

    group = pd.DataFrame({"key": every.view(np.int64), "n": n})
    values = ctw._values(group, ctw.top_nodes(ctw._roots(group)))
    own = values["key"].to_numpy().view(np.uint64) >> np.uint64(8) << np.uint64(8) == context
    assert (10 ** values["value"][own]).sum() == pytest.approx(1)


def test_licences_are_inherited_from_the_nearest_directory(spark, odd, none):
    rows = [
        (1, "a/LICENCE", "Released under the MIT License."), (2, "a/x/LICENCE", "Licensed under the Apache License, Version 2.0."),
        (3, "a/x/y/code", "Nothing said here."), (4, "a/z/code", None), (5, "b/code", "Plain."),
        (6, "a/x/own", "Some long text here with many more words than the notice has in it.\nLicensed under CC BY-NC 4.0."),
        (7, None, "Plain."), (5, "b/code", "Plain."),
    ]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, path string, text string, headers int")
    got = {r.doc_id: (r.licence, r.origin) for r in licences.scanned(docs, F.col("path")).collect()}
    assert got == {
        1: ("MIT", "file"), 2: ("Apache-2.0", "file"), 3: ("Apache-2.0", "inherited"), 4: ("MIT", "inherited"),
        5: (None, None), 6: ("CC-BY-NC", "header"), 7: (None, None),
    }
    assert licences.scanned(odd, F.lit("x/y")).count() == len(ODD)
    assert licences.scanned(none, F.lit("x")).count() == 0


def test_a_text_of_mostly_licence_lines_is_a_licence_file(spark):
    rows = [
        (1, "a/notice-of-no-such-name", "Released under the MIT License.\nTo all of you."), (2, "a/x/code", "Plain."),
        (3, "b/code", "Released under the MIT License.\nThen five more words follow, and a sixth."), (4, "b/other", "Plain."),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r.doc_id: (r.licence, r.origin) for r in licences.scanned(docs, F.col("path")).collect()}
    assert got == {1: ("MIT", "file"), 2: ("MIT", "inherited"), 3: ("MIT", "header"), 4: (None, None)}


def test_whole_licence_texts_and_header_blocks_are_known(spark):
    text = {n: (Path(licences.__file__).parent / "licence_texts" / f"{n}.txt").read_text() for n in licences.TEXTS}
    grant = "Copyright (c) 2020 Some One\n\n" + text["MIT"].removeprefix("MIT License\n\n")
    commented = "#!/bin/sh\n#\n" + "".join(f"# {line}\n" for line in text["GPL.header"].splitlines()) + "\n" + "let us go on\n" * 300
    rows = [
        (1, "m/LICENSE", grant), (2, "m/src/code", "Nothing said."), (3, "a/COPYING", text["Apache-2.0"]),
        (4, "a/code", "Plain."), (5, "b/text-without-such-a-name", text["BSD"]), (6, "b/code", "Plain."),
        (7, "g/tool.sh", commented), (8, "g/code", "Plain."), (9, "l/COPYING.LESSER", text["LGPL.2"]),
        (10, "p/story", "We gave no warranty and no licence for it.\n" * 3 + "Plain words. " * 50),
    ]
    got = {
        r.doc_id: (r.licence, r.origin)
        for r in licences.scanned(spark.createDataFrame(rows, "doc_id long, path string, text string"), F.col("path")).collect()
    }
    assert got == {
        1: ("MIT", "file"), 2: ("MIT", "inherited"), 3: ("Apache-2.0", "file"), 4: ("Apache-2.0", "inherited"),
        5: ("BSD", "file"), 6: ("BSD", "inherited"), 7: ("GPL", "header"), 8: (None, None), 9: ("LGPL", "file"),
        10: (None, None),
    }


def test_pipeline_matches_its_stages(spark):
    got = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()}
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = [decontamination.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in workload.quality_rules(spark, SF).where("kept").collect()}
    kept &= {r.doc_id for r in workload.quality_classifier(spark, SF).where("predicted = 1").collect()}
    sets, groups = {d: shingled(docs[d])[1] for d in sorted(kept)}, []
    for d, own in sets.items():
        near = [g for g in groups if any(len(own & sets[o]) >= 0.8 * len(own | sets[o]) for o in g)]
        groups = [g for g in groups if g not in near] + [sum(near, []) + [d]]
    leads = {min(g) for g in groups}
    clean = {d for d in leads if not any(i in decontamination.normal(docs[d]) for i in items)}
    assert set(got) == clean
