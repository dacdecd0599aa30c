"""The training-data operators against brute force on small tables with nulls, empty and long texts, ties and repeats."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from clickloom.llm import decontam, langid, lines, neardup, packing, ppm, quality, substring, tokcount, toxicity

public_tokenizers = pytest.importorskip("public_tokenizers")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=3):
    r = random.Random(seed)
    words = [f"{a}{b}" for a in ("ta", "ri", "mo", "lé", "Sun", "x9") for b in ("n", "k", "lo", "ß", "ven", ",")]
    say = lambda n: " ".join(r.choice(words) for _ in range(n))
    passage = say(60)
    docs = {i: "\n".join(say(r.randint(3, 40)) for _ in range(r.randint(1, 5))) for i in range(40)}
    for i in range(40, 52):  # near copies of one text
        near = docs[0].split(" ")
        for _ in range(r.randint(0, 4)):
            near[r.randrange(len(near))] = r.choice(words)
        docs[i] = " ".join(near)
    docs |= {52: docs[1], 53: docs[1], 54: f"{say(5)}\n{passage}\n{say(4)}", 55: f"{passage} {say(3)}", 56: "", 57: " \n\t ", 58: "one", 59: "one", 60: "w" * 3000, 61: say(9000), 62: " ".join(["again"] * 200), 63: "a  b c \n d '" + "s's <|endoftext|> 12!"}
    return docs


@pytest.fixture(scope="module")
def texts():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en" if i % 2 else "fr", f"src{i % 3}", len(t)) for i, t in texts.items()] + [(64, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 3 > 0), int(i % 5 == 0)) for i in range(50)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def bench(spark, texts):
    w = texts[54].split()
    return spark.createDataFrame([(1, " ".join(w[10:30]).upper()), (2, "one"), (10, None), (3, ""), (None, "ta ri"), (11, " ".join(w[10:30]))], "item_id long, text string")


def words(text, lower=True):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def test_ppm_and_base(docs, texts, empty):
    out = {r.doc_id: r for r in ppm.lm_scores(docs, block_bytes=4000).collect()}
    held = {i for i in [*texts, 64] if zlib.crc32(str(i).encode()) % 10 == 0}
    count, ends, trie = Counter(), 0, ppm.Trie()
    for i in [*texts, 64]:
        if i not in held:
            count.update(words(texts.get(i)))
            ends += 1
            data = b"\n" * ppm.ORDER + ppm.normal(texts.get(i))
            for k in range(ppm.ORDER, len(data)):
                trie.add(data[k - ppm.ORDER : k], data[k])
    n, v = sum(count.values()) + ends, len(count) + 1
    for i in [*texts, 64]:
        w, r = words(texts.get(i)), out[i]
        base = sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in [*(count[x] for x in w), ends])
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (i in held, len(w) + 1, sum(count[x] > 0 for x in w) + 1, n)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(trie.text(texts.get(i)))
    assert ppm.lm_scores(empty).count() == 0
    assert ppm.adaptive_scores(docs).filter("score >= 0").count() == 0
    assert sum(10 ** trie.log10(b"tan r"[-ppm.ORDER :], s) for s in range(256)) == pytest.approx(1)


def test_scores_tell_white_space_apart(spark):
    """Repeated rows are scored each and alike; white space is coded; a null text is the end sign alone."""
    rows = [(i, f"tan rilen {i % 7} mosk tan", i) for i in range(60)] + [(1, "tan rilen 1 mosk tan", 0), (70, "tan  rilen", 0), (71, "tan\trilen", 0), (72, "tan rilen", 0), (73, None, None)]
    out = ppm.lm_scores(spark.createDataFrame(rows, "doc_id long, text string, held_out long")).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows) and len({(r.score, r.base_score) for r in out if r.doc_id == 1}) == 1
    assert len({by[i].score for i in (70, 71, 72)}) == 3 and by[72].score > by[70].score and by[73].n_tokens == 1


def test_lines(docs, texts, empty, spark):
    found = {r.doc_id: r.lines for r in lines.dedup_lines(docs.withColumn("th", F.lit(1))).collect()}
    gone, seen = defaultdict(list), []
    for i in sorted(texts):
        for k, line in enumerate(texts[i].split("\n")):
            s = frozenset(words(line))
            if s and any(100 * len(s & x) >= 80 * len(s | x) for x in seen):
                gone[i].append(k)
            if s:
                seen.append(s)
    for i, t in texts.items():
        assert (found[i].gone, found[i].n) == (gone[i], t.count("\n") + 1)
        assert found[i].text == "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[i])
    assert (found[64].n, found[64].text) == (0, None) and lines.dedup_lines(empty).count() == 0


def test_crowded_lines(spark):
    """More classes under a word than CROWD, most of them similar to some earlier one."""
    r = random.Random(1)
    core = [f"c{i}" for i in range(20)]
    rows = []
    for i in range(120):
        w = list(core)
        for _ in range(r.randint(1, 3)):
            w[r.randrange(20)] = f"v{r.randrange(40)}"
        rows.append((i, " ".join(w)))
    found = {x.doc_id: x.lines.gone for x in lines.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = [frozenset(t.split()) for _, t in rows]
    for i, s in enumerate(sets):
        assert found[i] == ([0] if any(100 * len(s & x) >= 80 * len(s | x) for x in sets[:i]) else [])


@pytest.mark.parametrize("kind", ["one document", "large ids"])
def test_crowded_lines_in_any_order(spark, kind):
    """Pivot order (ties by class hash) against the order of first lines, under words with more partners than CROWD."""
    r = random.Random(2)
    core = [f"c{i}" for i in range(12)]
    rows = [" ".join([*(f"v{r.randrange(30)}" if r.random() < 0.12 else w for w in core), *(f"w{r.randrange(30)}" for _ in range(r.randint(0, 2)))]) for _ in range(100)]
    sets = [frozenset(t.split()) for t in rows]
    gone = [i for i, s in enumerate(sets) if any(100 * len(s & x) >= 80 * len(s | x) for x in sets[:i])]
    if kind == "one document":
        d = [(1, "\n".join(rows))]
    else:
        d = [((1 << 28) + 5 * i, t) for i, t in enumerate(rows)]
        r.shuffle(d)
    found = lines.dedup_lines(spark.createDataFrame(d, "doc_id long, text string")).collect()
    assert gone == (found[0].lines.gone if kind == "one document" else sorted((x.doc_id - (1 << 28)) // 5 for x in found if x.lines.gone))


def test_quality(docs, texts, labels, empty):
    import regex

    out = {r.doc_id: r for r in quality.judged(docs, labels).collect()}
    for i, t in texts.items():
        w = words(t, lower=False)
        c = Counter(zip(w, w[1:], w[2:]))
        covered = {j + k for j in range(len(w) - 2) if c[tuple(w[j : j + 3])] > 1 for k in range(3)}
        rows = [x for x in t.split("\n") if regex.search(r"[^\x20\x09-\x0D]", x)]
        r, failed = out[i], len(w) < 50 or 100 * len(covered) > 50 * len(w)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(w), sum(len(x.decode()) for x in w), len(regex.findall(r"[#*$%&|<>]", t)), len(rows) - len(set(rows)), len(covered), failed)
        assert not (failed and r.kept)
    assert out[64].base_failed and not out[64].kept and quality.judged(empty, labels).count() == 0
    assert quality.judged(docs, labels.limit(0)).filter("kept <> (not base_failed)").count() == 0


def test_certified_cutoffs():
    assert quality.binomial_tail(2, 10, 0.3) == pytest.approx(sum(math.comb(10, k) * 0.3**k * 0.7 ** (10 - k) for k in range(3)))
    good, bad = np.zeros(quality.BINS + 1, int), np.zeros(quality.BINS + 1, int)
    good[0], bad[50], good[50] = 5000, 400, 2
    assert quality.certify(good, bad, 0.01, 0.01) == 50
    assert quality.certify(good // 100, bad, 0.01, 0.01) is None  # too few labels to certify
    rng, broken = np.random.default_rng(0), 0
    for _ in range(200):  # the true false rejection rate of a chosen cutoff exceeds alpha in few runs
        score = rng.integers(0, 100, 3000)
        cut = quality.certify(np.bincount(score, minlength=quality.BINS + 1), np.bincount(rng.integers(90, 100, 3000), minlength=quality.BINS + 1) * 50, 0.05, 0.05)
        broken += cut is not None and (100 - cut) / 100 > 0.05
    assert broken <= 20


def test_token_counts(docs, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    out = {r.doc_id: r for r in tokcount.token_counts(docs, VOCABULARY).collect()}
    c = tokcount.counter(VOCABULARY)
    r = random.Random(5)
    odd = ["".join(r.choice(["a", "'s", "'", " ", "  ", "\n", "é", "12", "½", "日", "!!", "\x1c", "\x85", "<|endoftext|>", "The", "\r\n", "ـ"]) for _ in range(r.randint(0, 40))) for _ in range(300)]
    for t in [*texts.values(), *odd]:
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert {tokcount.count_tokens(c, t, chunk) for chunk in (5, 64, 1 << 16)} == {n}
    for i, t in texts.items():
        n = len(library.encode(t, add_special_tokens=False).ids)
        assert (out[i].n_bytes, out[i].n_tokens, out[i].over_limit) == (len(t.encode()), n, n > 1024)
    assert (out[64].n_bytes, out[64].n_tokens) == (0, 0)


def test_toxicity(spark, docs, labels, empty):
    r = random.Random(2)
    plain = [f"w{i}" for i in range(200)]
    rows = []
    for i in range(400):
        w = [r.choice(plain) for _ in range(r.randint(5, 80))]
        if i % 4 == 0:
            for k in range(2):
                w.insert(r.randrange(len(w)), ["vilegrub", "V1LEGRUB", "vіlegrub", "sludgeon"][(i + k) % 4])
        rows.append((i, " ".join(w)))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    out = toxicity.with_scores(d, marks).join(marks, "doc_id").collect()
    assert sum((x.tox_score >= 0.5) == x.toxic for x in out) >= 395
    m = toxicity.Matcher({" ciown": 2.0}, ("clown fish",))
    assert m.features("a clown fish swims") == (0.0, 0.0) and m.features("you C1OWN!")[0] > 0
    assert toxicity.with_scores(docs, labels.limit(0)).filter("tox_score >= 0.5").count() == 0
    assert toxicity.with_scores(docs, labels).count() == docs.count() and toxicity.with_scores(empty, labels).count() == 0


def test_toxic_words_beside_double_spaces():
    m = toxicity.Matcher({" siur ": 2.0})
    assert m.features("siur off") == m.features("siur  off") == m.features("off  siur") == m.features("off, siur") and m.features("siur  off")[0] > 0


def test_decontamination(docs, texts, bench, empty):
    out = {r.doc_id: r for r in decontam.digest(decontam.scan(docs.withColumn("row", F.lit("x")), bench)).collect()}
    pattern = __import__("regex").compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    items = {}
    for b in bench.collect():
        w = pattern.findall(lower(b.text))
        items.setdefault(b.item_id, set()).update({tuple(w[k : k + min(13, len(w))]) for k in range(len(w) - min(13, len(w)) + 1)} if w else set())
    for i, t in texts.items():
        w, hit, held = pattern.findall(lower(t)), set(), set()
        for item, windows in items.items():
            for win in windows:
                for k in range(len(w) - len(win) + 1):
                    if tuple(w[k : k + len(win)]) == win:
                        hit |= set(range(k, k + len(win)))
                        if item is not None:
                            held.add(str(item))
        r = out[i]
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (len(w), len(hit), len(held), bool(hit) and 20 * len(hit) >= len(w))
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
    assert decontam.scan(docs, bench.limit(0)).filter("decontam.contaminated").count() == 0 and decontam.clean_documents(empty, bench).count() == 0
    assert decontam.clean_documents(docs, bench).filter("doc_id in (54, 58)").count() == 0
    spans = {r.doc_id: r.text for r in decontam.clean_spans(docs, bench).collect()}
    assert spans[58] == "" and spans[2] == texts[2]
    plan = decontam.scan(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
    joined = {r.doc_id: r for r in decontam.digest(decontam.scan(docs, bench, limit=0)).collect()}  # nothing is broadcast
    assert joined == out


def test_items_without_id_hit(spark):
    passage = " ".join(f"word{i}" for i in range(13))
    docs, bench = spark.createDataFrame([(1, passage.upper()), (2, "clean")], "doc_id long, text string"), spark.createDataFrame([(None, passage)], "item_id long, text string")
    assert [tuple(r)[1:4] + (r.contaminated,) for r in decontam.digest(decontam.scan(docs, bench)).orderBy("doc_id").collect()] == [(13, 13, 0, True), (1, 0, 0, False)]


def test_substrings(docs, texts, empty):
    out = {r.doc_id: r for r in substring.strip_repeats(docs, window=6, block_bytes=4000).collect()}
    w = {i: words(t, lower=False) for i, t in texts.items()}
    count = Counter(tuple(x[k : k + 6]) for x in w.values() for k in range(len(x) - 5))
    for i, x in w.items():
        gone = {k + j for k in range(len(x) - 5) if count[tuple(x[k : k + 6])] > 1 for j in range(6)}
        assert (out[i].n_words, out[i].n_removed) == (len(x), len(gone))
        assert out[i].kept == b" ".join(v for k, v in enumerate(x) if k not in gone).decode()
        assert {p for a, b in zip(out[i].spans[::2], out[i].spans[1::2], strict=True) for p in range(a, b)} == gone
    assert out[64].n_words == 0 and substring.strip_repeats(empty).count() == 0


def test_packing(docs, texts, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    rows = packing.pack(docs.repartition(9), VOCABULARY).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for i in [*texts, 64]:
        ids = np.array([*library.encode(texts.get(i) or "", add_special_tokens=False).ids, 2], dtype="<u4")
        pieces = sorted(by_doc[i], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in pieces] == packing.cut(len(ids)) and all(r.length == 1024 for r in pieces[1:])
        assert all(zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for r in pieces)
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
    assert len(by_seq) <= 1 + math.ceil(sum(r.length for r in rows) / 1024) and packing.pack(empty, VOCABULARY).count() == 0
    sizes = np.array([600, 500, 400, 300, 200, 24, 24])
    assert sorted(sum(sizes[i] for i in b) for b in packing.best_fit(sizes)) == [1024, 1024]


def test_packing_of_sorted_lengths(spark):
    """Long texts in one partition, those that fill their sequences in another: none stays underfull."""
    rows = [(i, " ".join(["the"] * n)) for i, n in enumerate([699] * 5000 + [299] * 5000)]
    found = packing.pack(spark.createDataFrame(spark.sparkContext.parallelize(rows, 2), "doc_id long, text string"), VOCABULARY)
    by_seq = defaultdict(list)
    for r in found.collect():
        by_seq[r.sequence_id].append((r.offset, r.length))
    assert sorted(by_seq) == list(range(5000)) and all(sorted(x) == [(0, 700), (700, 300)] for x in by_seq.values())
    assert packing.plan({700: 110_000, 300: 110_000})[0] == 110_000


def test_ids_of_packing():
    """Ids put together from stretches are the library's, whatever white space, signs and special strings meet."""
    r, ids = random.Random(5), packing.Ids(VOCABULARY)
    common = ["a", "the", "Word", "don't", "'s", "12", ".", ",", "!?", "é", "日本", "\n", "\n", "\n\n", *" " * 5, "'re"]
    odd = ["x1", "3.5", "#", "\n\n\n", "  ", "\t", "\r\n", "\u3000", "\xa0", "\x1c", "\x85", "\x00", "\ufeff", "\u0301", "\ufb01", "<|endoftext|>", "\n'", " \n", "\n "]
    for some in (common, common + odd):
        for n in (0, 1, 300, 3000):
            texts = ["".join(r.choice(some) for _ in range(r.randint(0, 14))) for _ in range(n)]
            assert ids.texts(pa.array(texts, pa.string())) == [ids.whole(t) for t in texts]


def test_packing_by_tree(spark):
    """Small nodes, so that bins go up several rounds: gapless, nothing lost or doubled, and few sequences more than the least."""
    r = random.Random(11)
    rows = [(i % 900, None if i % 97 == 0 else " ".join(["the"] * min(1500, int(r.lognormvariate(5, 1.2))))) for i in range(1500)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for leaf, most in ((1 << 16, 1.002), (100, 1.05), (1, 3)):
        found, by_seq = packing.pack(d, VOCABULARY, leaf=leaf).collect(), defaultdict(list)
        for x in found:
            by_seq[x.sequence_id].append((x.offset, x.length))
        lengths = [len(t.split()) + 1 if t else 1 for _, t in rows]
        assert Counter(x.length for x in found) == Counter(n for size in lengths for _, n in packing.cut(size))
        for places in map(sorted, by_seq.values()):
            ends = np.cumsum([n for _, n in places])
            assert ends[-1] <= 1024 and [o for o, _ in places] == [0, *ends[:-1].tolist()]
        assert len(by_seq) <= most * math.ceil(sum(lengths) / 1024) + 1


def test_bins_without_partners_stay(spark):
    """No two pieces fit together: a round that joins none ends the tree, each piece has a sequence of its own."""
    rows = [(i, " ".join(["the"] * 699)) for i in range(300)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), VOCABULARY, leaf=50).collect()
    assert len({x.sequence_id for x in found}) == len(found) == 300 and all(x.offset == 0 for x in found)


def test_plan_is_best_fit():
    rng = np.random.default_rng(1)
    for top in (40, 300, 1024):
        for n in (0, 1, 50, 3000):
            sizes = rng.integers(1, top + 1, n)
            bins, rows = packing.plan(Counter(sizes.tolist()))
            want = Counter(tuple(sorted(sizes[i] for i in b)) for b in packing.best_fit(sizes))
            got, ends = defaultdict(list), rows[:, 1].tolist()
            for k, (size, first, each, b, at) in enumerate(rows.tolist()):
                last = ends[k + 1] if k + 1 < len(rows) and rows[k + 1, 0] == size else (sizes == size).sum()
                for i in range(last - first):
                    got[b + i // each].append((at + i % each * size, size))
            assert Counter(tuple(sorted(s for _, s in x)) for x in got.values()) == want and sorted(got) == list(range(bins))
            for x in got.values():
                assert sum(s for _, s in x) <= 1024 and [o for o, _ in sorted(x)] == np.cumsum([0, *(s for _, s in sorted(x))])[:-1].tolist()


def test_language(spark, docs, empty):
    r = random.Random(4)
    speech = {"aa": ["tavo", "rilen", "mosk"], "bb": ["zuhr", "kwopf", "schtz"], "cc": ["при", "вода", "хлеб"]}
    rows = [(i, " ".join(r.choice(speech[k]) for _ in range(r.randint(3, 60))), k) for i in range(150) for k in ["aabbcc"[2 * (i % 3) :][:2]]]
    rows += [(200, "123 !!", "aa"), (201, None, "bb"), (202, "tavo rilen mosk tavo rilen zuhr kwopf schtz zuhr kwopf schtz zuhr", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {x.doc_id: x for x in langid.languages(d).collect()}
    assert all(out[i].lang_pred == k for i, _, k in rows[:150]) and out[200].lang_pred == out[201].lang_pred == "und"
    assert out[202].lang_pred == "bb" and out[202].n_spans == 2
    assert [x[2] for x in langid.spans(langid.fit(d), rows[-1][1])] == ["aa", "bb"]
    assert {x.lang_pred for x in langid.languages(d.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langid.languages(empty).count() == 0 and langid.languages(docs).count() == docs.count()


def test_scripts_and_signs(spark):
    """Scripts by code point; quotes and dashes part words; a text of letters in no word still gets a language."""
    names = ["other", *langid.SCRIPT_RANGES]
    for text, want in [("a\u201cb", ["latin", "sign", "latin"]), ("\u1ebft", ["latin", "latin"]), ("\u0915\u0e01\u05d0\u0561", ["devanagari", "thai", "hebrew", "armenian"]), ("\u4e2d\u3042\U00020000", ["han", "kana", "han"]), ("1\u0301", ["other", "other"])]:
        got, data = langid.scripts(np.frombuffer(text.encode(), dtype=np.uint8)), text.encode()
        firsts = [i for i, c in enumerate(data) if c & 0xC0 != 0x80]
        assert [names[got[i]] for i in firsts] == want
    words = langid.features(pa.array(["\u201ctavo\u201d\u2014rilen"]))[0]
    assert [bytes(words.buf[a:b]) for a, b in zip(words.start, words.end, strict=True)] == [b"tavo", b"rilen"]
    rows = [(i, ["tavo rilen", "\u043f\u0440\u0438 \u0432\u043e\u0434\u0430"][i % 2] + f" {i}", "ab"[i % 2]) for i in range(40)]
    rows += [(100, "\u201ctavo\u201d \u2013 \u201crilen\u201d", None), (101, "\u00bd \u2014", None), (102, "\u2135", None)]
    rows += [(103, "\u201ctavo\u201d", None), (103, "\u201ctavo\u201d", None), (103, "\u0432\u043e\u0434\u0430", None)]
    out = sorted((x.doc_id, x.lang_pred) for x in langid.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect() if x.doc_id >= 100)
    assert out[:2] == [(100, "a"), (101, "und")] and out[2][1] in "ab" and out[3:] == [(103, "a"), (103, "a"), (103, "b")]


def test_viterbi_is_optimal():
    rng = np.random.default_rng(0)
    for _ in range(20):
        count = rng.integers(0, 12, 20)
        score = rng.normal(size=(count.sum(), 3)) * 3
        label, at = langid.viterbi(score, count, 2.0), 0
        for c in count:
            x, y = score[at : at + c], label[at : at + c]
            if c:
                v = x[0]
                for k in range(1, c):
                    v = np.maximum(v, v.max() - 2.0) + x[k]
                assert x[np.arange(c), y].sum() - 2.0 * (y[1:] != y[:-1]).sum() == pytest.approx(v.max())
            at += c


def groups(sets, percent=80):
    top = {i: i for i in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            m = len(sets[a] & sets[b])
            if m and 100 * m >= percent * (len(sets[a]) + len(sets[b]) - m):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {i: root(i) for i in ids}


def shingles(text, size):
    w = words(text)
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set()


def test_near_duplicates(docs, texts, empty):
    out = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    sets = {i: shingles(t, 2) for i, t in texts.items()}
    want = groups(sets)
    for i in texts:
        assert (out[i].n_shingles, out[i].component_id, out[i].kept) == (len(sets[i]), want[i], want[i] == i)
    assert (out[64].n_shingles, out[64].component_id, out[64].kept) == (0, 64, True) and neardup.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("block", [2048, 9])
def test_crowded_near_copies(spark, monkeypatch, block):
    """A large group around one text, some of whose members are linked only among themselves or not at all."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "CROWD", 4)
    r = random.Random(9)
    core = [f"k{i}" for i in range(90)]
    rows = []
    for i in range(150):
        w = list(core)
        for _ in range(r.choice([1, 2, 4, 7, 10, 14])):
            at = r.randrange(len(w))
            w[at : at + 1] = r.choice([[], [f"z{r.randrange(30)}"], [w[at], f"z{r.randrange(30)}"]])
        rows.append((i, " ".join(w)))
    out = {x.doc_id: x.component_id for x in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == groups({i: shingles(t, 2) for i, t in rows})


def test_unlike_texts_of_one_id(spark, tmp_path):
    """Rows that share an id stay unless their texts are near copies of a kept one."""
    r = random.Random(5)
    a, b, c = (" ".join(f"{k}{r.randrange(1000)}" for _ in range(80)) for k in "abc")
    rows = [(1, a), (1, b), (2, b + " more"), (2, c), (3, a), (3, a), (None, a)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, d, str(tmp_path)).collect()
    assert sorted(((x.doc_id or 0, x.text) for x in kept)) == sorted([(0, a), (1, a), (1, b), (2, c)])
    found = neardup.near_duplicates(d, size=5).collect()
    assert Counter((x.doc_id, x.component_id, x.kept) for x in found) == Counter({(1, 1, True): 2, (2, 1, False): 1, (2, 2, True): 1, (3, 1, False): 2, (None, None, True): 1})


def test_posterior_bounds():
    need = neardup.least_matches(miss=1e-4)
    assert need == sorted(need) and 0 < need[0] < 40 and need[-1] < 128


def test_pipeline(spark, tmp_path, docs, bench, labels, texts):
    for name, df in (("documents", docs), ("benchmark", bench), ("labels", labels)):
        df.coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    clash = docs.limit(5)
    for name in ("row", "words", "hits", "lines", "tox_score", "decontam", "block", "key", "bucket", "th", "given"):
        clash = clash.withColumn(name, F.lit(name))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        same = stage(spark, clash, str(tmp_path))
        assert same.columns == clash.columns and same.filter("row <> 'row' or hits <> 'hits' or th <> 'th' or lines <> 'lines'").count() == 0
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, d, str(tmp_path)).write.parquet(f"{tmp_path}/stage{k}")
        d = spark.read.parquet(f"{tmp_path}/stage{k}")
        assert d.columns == docs.columns
    kept = {r.doc_id for r in d.collect()}
    assert 54 not in kept and 2 in kept
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept
    near = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    want = groups({i: shingles(t, 5) for i, t in texts.items()})
    assert {r.doc_id for r in near.collect()} == {i for i in texts if want[i] == i} | {64}


def test_pa_slices_cover_all_rows():
    from clickloom.llm.arrays import slices

    t = pa.table({"text": ["a" * 10, None, "", "b" * 100, "c"]})
    assert [x for b in slices(t, 12) for x in b.column("text").to_pylist()] == ["a" * 10, "", "", "b" * 100, "c"]
