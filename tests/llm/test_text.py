"""Fingerprints, quality rules, personal data, page text and the language model."""
import base64
import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from snapline.llm import html_mincut, kneser_ney, pii, quality_rules, syncmer
from tests.conftest import SF_SMALL

PROSE = ("The quick brown fox jumps over the lazy dog while the band plays on and nobody minds the rain, "
         "because summer is short in this part of the country. ")


# --- fingerprints -----------------------------------------------------------------------

def slow_anchors(t, k=12, s=5):
    """Places of the closed syncmers by the definition, s-mers ordered by the library's hash."""
    if len(t) < k:
        return [0] if t else []
    rank = {}

    def code(x):
        if x not in rank:
            _, _, c = syncmer.anchors([x], k=s, s=s)
            rank[x] = c[0]
        return rank[x]
    out = []
    for i in range(len(t) - k + 1):
        inner = [code(t[j:j + s]) for j in range(i, i + k - s + 1)]
        if min(inner) in (inner[0], inner[-1]):
            out.append(i)
    return out or [0]


def test_anchors_do_not_depend_on_context():
    texts = ["", "short", PROSE, "x" + PROSE, PROSE + "y", "ééé" + PROSE * 2]
    who, at, code = syncmer.anchors(texts)
    inside = [dict(zip(at[who == i].tolist(), code[who == i].tolist())) for i in range(len(texts))]
    assert inside[0] == {} and list(inside[1]) == [0]
    assert {p + 1: c for p, c in inside[2].items()}.items() <= inside[3].items()
    assert inside[2].items() <= inside[4].items()
    assert {p + 3: c for p, c in inside[2].items()}.items() <= inside[5].items()
    gaps = np.diff(sorted(inside[2]))
    assert gaps.max() <= 12 - 5 + 1                       # a window guarantee of closed syncmers


def test_fingerprints_match_brute_force(spark):
    texts = [PROSE, PROSE, "", None, "tiny", PROSE.upper() * 3, "ab" * 400, PROSE[:90] + "changed " + PROSE[98:], "é" * 13]
    rows = [(i * 3 - 4, t, 9, "x") for i, t in enumerate(texts)] + [(None, "nobody", 9, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars int, fingerprint string")
    got = {r["doc_id"]: r for r in syncmer.fingerprints(df).collect()}
    order = sorted([r for r in rows if r[0] is not None], key=lambda r: -r[0]) + [rows[-1]]
    assert len(got) == len(rows)
    for a, b in zip(order, order[1:] + order[:1]):
        t, nxt = a[1] or "", b[1] or ""
        e = t[:len(t) - len(t) // 2] + nxt[:len(t) // 2]
        x, y, z = syncmer.sketches([t, e, nxt])
        r = got[a[0]]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
        assert base64.b64decode(r["fingerprint"]) == x.tobytes() and base64.b64decode(r["edited_fingerprint"]) == y.tobytes()
        assert r["near_edited"] == syncmer.likeness(x, y) and r["near_next"] == syncmer.likeness(x, z)
    assert got[-4]["fingerprint"] == got[-1]["fingerprint"]
    one = syncmer.fingerprints(df.where("doc_id = -4")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    assert syncmer.fingerprints(df.limit(0)).count() == 0


def test_long_texts_that_differ_in_a_passage(spark):
    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnop"), 6)) for _ in range(3000)]
    for _ in range(10):
        long = list(rng.choice(words, 20_000))
        other = long[:]
        at = int(rng.integers(0, 19_900))
        other[at:at + 50] = rng.choice(words, 50)
        x, y = syncmer.sketches([" ".join(long), " ".join(other)])
        assert x.tobytes() != y.tobytes() and 0.97 < syncmer.likeness(x, y) < 1
        z = syncmer.sketches([" ".join(rng.choice(words, 20_000))])[0]
        assert syncmer.likeness(x, z) < 0.2
    assert len(syncmer.sample(x)[0]) > 1500                 # the sample grows with the text
    rows = [(1, " ".join(long)), (1, " ".join(other)), (2, " ".join(long))]
    got = syncmer.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len({r["fingerprint"] for r in got}) == 2 and len(got) == 3


def test_samples_by_brute_force():
    texts = [PROSE * n for n in (1, 3, 9, 40)] + ["ab" * 3000, "short", "x" * 9, PROSE + "y" * 200_000 + PROSE]
    who, at, code = syncmer.anchors(texts)
    for i, (t, s) in enumerate(zip(texts, syncmer.sketches(texts))):
        mine = sorted(zip(at[who == i].tolist(), code[who == i].tolist()))
        level = min(4, max(0, math.floor(math.log2(len(t) / (4 * 48)))))
        want = [(p, c >> 32) for p, c in mine if c >> 64 - level == 0] if level else [(p, c >> 32) for p, c in mine]
        hashes, places = syncmer.sample(s)
        assert s[2] & 255 == level and list(zip(places.tolist(), hashes.tolist())) == want


def test_passages_match_by_position():
    rng = np.random.default_rng(9)
    word = lambda: "".join(rng.choice(list("abcdefgh"), 5))
    passage = " ".join(word() for _ in range(60))
    x = " ".join(word() for _ in range(80)) + " " + passage
    y = passage + " " + " ".join(word() for _ in range(40))
    found = syncmer.shared_passages(x, y)
    assert all(x[a:a + n] == y[b:b + n] for a, b, n in found)
    assert max(n for _, _, n in found) > len(passage) - 30
    assert syncmer.shared_passages("", y) == []
    # Moved as a whole, a text stays like itself; a repeated one pairs in order, not in all ways.
    a, b = syncmer.sketches([passage * 3, "head " + passage * 3])
    assert syncmer.likeness(a, b) > 0.8


# --- quality rules ----------------------------------------------------------------------

def slow_measures(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    win = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    n = Counter(win)
    covered = {j for i, x in enumerate(win) if n[x] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_quality_rules_match_brute_force(spark):
    texts = ["", None, "a b c a b c a b", "x\n\nx\ny\nx", PROSE * 4, "#*$%&|<> é　ü\x85z", "w " * 3000, " \t\n ", "WORD! " * 60,
             " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)), " ".join(f"w{i}***" for i in range(200)), "a b c d a b c"]
    rows = [(i, t, 5, True) for i, t in enumerate(texts)] + [(None, "x", 5, True), (4, PROSE, 5, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int, kept boolean")
    got = quality_rules.apply_rules(df)
    assert "Python" not in got._jdf.queryExecution().toString()
    got = got.collect()
    assert len(got) == len(rows)
    for r in got:
        m = slow_measures(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == m
        assert r["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert kept[9] and not kept[10]
    assert quality_rules.apply_rules(df.limit(0)).count() == 0
    alone = quality_rules.apply_rules(df, []).collect()
    assert all(r["kept"] != r["base_failed"] for r in alone)


def test_order_of_rules_changes_no_verdict(spark):
    from pyspark.sql import functions as F
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    m = quality_rules.with_measures(docs)
    rules = quality_rules.standard_rules()
    v = m.select(quality_rules.cascade(rules).isNull().alias("a"), quality_rules.cascade(rules[::-1]).isNull().alias("b"))
    assert v.where("a <> b").count() == 0
    ordered = quality_rules.order_rules(m, [quality_rules.Rule("never", F.lit(False)), *rules], repeats=1)
    assert ordered[-1][1] == 0.0 and len(ordered) == len(rules) + 1


# --- personal data ----------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def slow_spans(t):
    out = []
    for kind, p in BASE.items():
        for m in re.finditer(p, t):
            d = re.sub("[^0-9]", "", m.group())
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                  "card": 12 <= len(d) <= 19 and pii.luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], pii.KINDS.index(s[0])))


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.text(alphabet="a1@.+- (05)é\n", max_size=50),
                 st.lists(st.sampled_from(["a@b.co", "1.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "+1 (372) 555-2774", " ", "x",
                                           "@", ".", "999", "+", "-"]), max_size=12).map("".join)))
def test_base_spans_are_the_patterns(t):
    assert [(s.kind, s.start, s.end) for s in pii.base_spans(t)] == slow_spans(t)


def test_votes_and_classifier(spark):
    texts = (["write to ann@mail.example.com or call +1 (372) 555-2774 now"] * 6 + ["host 10.1.2.3 and card 4111111111111111"] * 6
             + ["call (269) 555-3296 please"] * 6 + ["version 269-555-3296-1 x 12 269.555.3296"] * 2 + ["", None, "nothing here é"])
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[0], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, pii string")
    got = pii.digest(df).collect()
    assert len(got) == len(rows)
    for r, (_, t, _) in zip(sorted(got, key=lambda r: (r["doc_id"] is None, r["doc_id"])), rows):
        want = slow_spans(t or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w[0] == k for w in want) for k in pii.KINDS]
        assert r["base_sha256"] == hashlib.sha256(",".join("%s:%d:%d" % w for w in want).encode()).hexdigest()
        assert {"%s:%d:%d" % w for w in want} <= set(r["spans"].split(",")) | ({""} if want else set())
    assert pii.detect(df).columns == df.columns
    clean = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert clean[0] == "write to [EMAIL] or call [PHONE] now" and clean[6] == "host [IP] and card [CARD]"
    assert clean[20] == "" and clean[21] is None and clean[22] == texts[22]
    assert pii.digest(df.limit(0)).count() == 0
    assert pii.digest(df.where("doc_id = 22")).first()["spans"] == ""


def test_expectation_maximisation_finds_the_reliable_labeler():
    r = np.random.default_rng(1)
    truth = r.random(4000) < 0.5
    good = np.where(r.random(4000) < 0.95, truth, ~truth) * 2 - 1
    fair = np.where(r.random(4000) < 0.8, truth, ~truth) * 2 - 1
    also = np.where(r.random(4000) < 0.8, truth, ~truth) * 2 - 1
    noise = r.integers(-1, 2, 4000)
    rows = np.column_stack([np.zeros(4000, int), good, fair, also, noise])
    p = pii.expect_votes(rows, np.ones(4000))
    assert ((p > 0.5) == truth).mean() > 0.93


def test_addresses_of_many_zeros():
    zeros = "0" * 5000
    for t, n in ((f"{zeros}.1.2.3", 1), (f"1.2.{zeros}255.3", 1), (f"1.2.{zeros}256.3", 0)):
        assert sum(s.kind == "ip" for s in pii.base_spans(t)) == n


def test_loose_emails_do_not_need_another_cue():
    for a in ("(at)", "[at]", "( at)", "(at )", "( at )", "[at)", "( at]", "[ at ]"):
        assert [s.kind for s in pii.candidates(f"jo {a} host.com")] == ["email"], a


def test_redaction_follows_length(spark):
    df = spark.createDataFrame([(2 ** 60 + 1, "a@b.co x", 8, None), (None, None, None, 3)],
                               "doc_id long, text string, n_chars long, extra long")
    got = sorted(pii.redact(df).collect(), key=lambda r: r["doc_id"] is None)
    assert tuple(got[0]) == (2 ** 60 + 1, "[EMAIL] x", 9, None) and tuple(got[1]) == (None, None, None, 3)


# --- page text --------------------------------------------------------------------------

def best_labels(gain, edges):
    n = len(gain)
    cost = lambda m: (sum(max(g, 0) if not m >> i & 1 else max(-g, 0) for i, g in enumerate(gain))
                      + sum(w for a, b, w in edges if (m >> a & 1) != (m >> b & 1)))
    return min(cost(m) for m in range(1 << n)), cost


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-5, 5), min_size=1, max_size=8), st.lists(st.tuples(st.integers(0, 7), st.integers(0, 7), st.integers(1, 4)), max_size=12))
def test_cut_is_minimal(gain, raw):
    edges = [(a, b, w) for a, b, w in raw if a != b and a < len(gain) and b < len(gain)]
    least, cost = best_labels(gain, edges)
    side = html_mincut.max_flow_side([float(g) for g in gain], [(a, b, float(w)) for a, b, w in edges])
    assert cost(sum(1 << i for i, s in enumerate(side) if s)) == least


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="ad">Buy now.</div><!-- note <p>hidden</p> --><div id="cookie-notice"><p>We use cookies, do you agree?</p></div>
<article><h1>Title &amp; more</h1><p>First <b>para&eacute;</b>  with
 text.<br>Second line.<p>Third &lt;tag&gt; one<aside>Side note.</aside><form><p>Join us</p><input></form>
<ul><li>Point one<li>Point two</ul><p hidden>secret</p></article>
<section class="comments"><article><p>Great article, thank you very much for it.</p></article></section>
<footer>&copy; Site &middot; All rights.</footer></body></html>"""


def test_page_text(spark):
    rows = [(i, "u", PAGE, "old") for i in range(3)] + [(8, None, None, "old"), (9, "u", "", "old"), (10, "u", PAGE[:760], "old"),
                                                        (11, "u", "plain & simple", "old"), (None, "u", "<p>x" * 500, "old")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in html_mincut.extract(df).collect()}
    want = "Title & more\n\nFirst paraé with text. Second line.\n\nThird <tag> one\n\nPoint one\n\nPoint two"
    assert got[0]["text"] == got[2]["text"] == want and got[0]["n_chars"] == len(want)
    assert got[8]["text"] == got[9]["text"] == "" and got[8]["n_chars"] == 0
    assert want.startswith(got[10]["text"]) and got[10]["text"].startswith("Title & more\n\nFirst")
    assert html_mincut.extract(df.limit(0)).count() == 0


def test_page_text_of_the_tables(spark):
    """The article's blocks, read from the generator's plain markup."""
    import html
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    for r in html_mincut.extract(pages).collect():
        body = r["html"].partition("<article>")[2].partition("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>?", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n\n".join(b for b in blocks if b)


# --- language model ---------------------------------------------------------------------

def slow_fold(t):
    words, out = t.split(), ""
    for i, w in enumerate(words):
        again = any(i + 1 >= 2 * p and words[i + 1 - p:i + 1] == words[i + 1 - 2 * p:i + 1 - p] for p in (1, 2, 3, 4))
        out += "\x03" if again else (" " if i else "") + w
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab \n", max_size=40), max_size=6))
def test_fold_marks_repeated_phrases(texts):
    assert kneser_ney.fold(texts) == [slow_fold(t) for t in texts]


def test_fold_of_long_and_plain_texts():
    long = "the rain in spain " * 100_000
    assert kneser_ney.fold(["", long, PROSE * 2, " "])[::3] == ["", ""]
    assert kneser_ney.fold([long])[0] == "the rain in spain the rain in" + "\x03" * 399_993
    assert kneser_ney.fold([PROSE, "x x", "x"]) == [PROSE.strip(), "x\x03", "x"]


def slow_model(texts, order=4):
    """Interpolated modified Kneser-Ney by dictionaries; returns log p of a gram."""
    counts = [None] * (order + 1)
    counts[order] = Counter()
    for t in texts:
        s = "\x01" * (order - 1) + slow_fold(t) + "\x02"
        counts[order].update(s[i:i + order] for i in range(len(s) - order + 1) if s[i:i + order][-2:] != "\x03\x03")
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    disc = [None]
    for k in range(1, order + 1):
        n = [max(1, sum(c == i for c in counts[k].values())) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1])
        d = [0.0] + [min(max(i - (i + 1) * y * n[i] / n[i - 1], 0.0), float(i)) for i in (1, 2, 3)]
        disc.append(d)

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / (len(counts[1]) + 1)
        same = {x: c for x, c in counts[k].items() if x[:-1] == g[:-1]}
        if not same:
            return low
        total = sum(same.values())
        freed = sum(disc[k][min(c, 3)] for c in same.values())
        c = counts[k].get(g, 0)
        return (max(c - disc[k][min(c, 3)], 0) + freed * low) / total
    return lambda g: math.log(max(p(g), 1e-12))


def model_rows():
    import random
    r = random.Random(4)
    words = ["the", "rain", "in", "spain", "stays", "mainly", "plain", "and", "tom", "runs"]
    good = [" ".join(r.choice(words) for _ in range(r.randint(20, 60))) for _ in range(40)]
    bad = ["".join(r.choice("#*QXZ%9") for _ in range(200)) for _ in range(5)]
    return good, bad


def test_classifier_matches_brute_force(spark, monkeypatch):
    good, bad = model_rows()
    rows = [(i, t, "en", 1, "p") for i, t in enumerate(good + bad)] + [(100, None, "en", 1, "p"), (101, "", None, 1, "p"),
                                                                       (102, good[0], None, 1, "p"), (None, bad[0], "xx", 1, "p"), (0, good[0], "en", 1, "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, threshold int, perplexity string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(40, 0, 0), (41, 1, 1), (5, 1, None), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    got = kneser_ney.classify(df, labels, quantile=1.0, margin=1.0, steady=0, hold_out=0).collect()
    assert len(got) == len(rows)
    lp = slow_model([t for i, t, *_ in rows if i is not None and i < 40])
    worst = 0.0
    for r in got:
        s = "\x01" * 3 + slow_fold(r["text"] or "") + "\x02"
        want = math.exp(-sum(lp(s[i:i + 4]) for i in range(len(s) - 3)) / (len(s) - 3))
        assert r["perplexity"] == pytest.approx(want, rel=1e-9)
        if r["doc_id"] is not None and r["doc_id"] < 40:
            worst = max(worst, want)
    accepted = {r["doc_id"]: r["accepted"] for r in got}
    assert all(accepted[i] for i in range(40)) and not any(accepted[i] for i in range(40, 45))
    assert accepted[100] and accepted[101] and accepted[102] and not accepted[None]
    assert {round(r["threshold"], 9) for r in got} == {round(worst, 9)}
    # The join beyond the broadcast limit gives the same rows.
    monkeypatch.setattr(kneser_ney, "BROADCAST_GRAMS", 0)
    other = kneser_ney.classify(df, labels, quantile=1.0, margin=1.0, steady=0, hold_out=0).collect()
    key = lambda r: (str(r["doc_id"]), r["lang"] or "", round(r["perplexity"], 9), r["accepted"])
    assert sorted(map(key, got)) == sorted(map(key, other))


def test_probabilities_sum_to_one(spark):
    good, _ = model_rows()
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    assert kneser_ney.classify(df, labels).where("accepted").count() == 40
    lp = slow_model(good)
    letters = {c for t in good for c in t} | {"\x02", "\x03"}
    assert sum(math.exp(lp("the" + c)) for c in letters) <= 1.0 + 1e-9


def test_classifier_without_trusted_text(spark):
    df = spark.createDataFrame([(1, "a", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    r = kneser_ney.classify(df, labels).collect()
    assert len(r) == 1 and r[0]["accepted"] and r[0]["perplexity"] is None
    assert kneser_ney.classify(df.limit(0), labels).count() == 0
    # All trusted documents held out (nothing counted), or none (nothing to measure): no verdict.
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    for hold_out in (1, 1 << 60):
        r = kneser_ney.classify(df, labels, hold_out=hold_out).collect()
        assert len(r) == 1 and r[0]["accepted"] and r[0]["perplexity"] is None and r[0]["threshold"] is None


def test_held_out_accuracy(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    held = labels.where("doc_id % 4 = 0")
    got = kneser_ney.classify(docs, labels.where("doc_id % 4 <> 0")).join(held, "doc_id")
    clean = got.where("quality = 1 and toxic = 0")
    assert clean.where("accepted").count() >= 0.97 * clean.count()
    junk = got.where("quality = 0").select("text", "accepted").collect()
    kinds = Counter((junk_kind(r["text"]), r["accepted"]) for r in junk)
    assert not [k for k in kinds if k[1]], kinds


def junk_kind(t):
    words = t.split()
    if len(set(words)) <= max(1, len(words) // 10):
        return "one word repeated"
    if "!!" in t:
        return "upper case"
    return "pipes" if " | " in t else "symbols" if re.search(r"[$%&*#]{3}", t) else "other"


def test_every_kind_of_junk_is_rejected(spark):
    """All junk among the labels, none of it read by the model, by kind."""
    sf = SF_SMALL.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = kneser_ney.classify(docs, labels).join(labels.where("quality = 0").select("doc_id").distinct(), "doc_id")
    kinds = Counter((junk_kind(r["text"]), r["accepted"]) for r in got.collect())
    assert {k for k, _ in kinds} >= {"one word repeated", "upper case", "pipes", "symbols"}
    assert not [k for k in kinds if k[1]], kinds


ODDS = {"stop=True": 1.0, "stop=False": -1.0, "comma=True": 0.5, "words=0": -1.0, "words=1": -0.8, "words=4": 1.0,
        "words=5": 1.0, "links=0": 0.3, "links=3": -1.5, "tag=p": 0.5, "tag=li": -0.5}


@pytest.mark.parametrize("wrap", [
    "<div class='sidebar-right'><article>{}</article></div>", "<form id='aspnetForm'><article>{}</article></form>",
    "<div class='has-sidebar'>{}</div>", "<div class='page-with-header'>{}</div>", "<form id='aspnetForm'><div>{}</div></form>",
    "<div class='search-page'><main>{}</main></div>", "<article class='social-policy'>{}</article>",
    "<div data-note='no longer hidden'>{}</div>", "<div class='has-sidebar'><div class='page-with-header'><div><div>{}</div></div></div></div>"])
def test_wrappers_keep_their_article(wrap):
    text = [PROSE * 2, PROSE + "And more, of course.", PROSE * 3]
    page = ("<body><nav><ul><li><a href=/>Home</a><li><a href=/x>About us</a></ul></nav>"
            + wrap.format("".join(f"<p>{t}</p>" for t in text))
            + "<div class='comments'><article><p>" + PROSE + "</p></article></div><footer>All rights reserved</footer></body>")
    want = "\n\n".join(" ".join(t.split()) for t in text)
    assert html_mincut.main_text(page, ODDS) == want


def test_the_cut_overrules_structure():
    deep = "<article>" + "<div>" * 9 + "<ul><li>Share<li>Tweet<li>Mail</ul>" + "</div>" * 9 + "".join(
        f"<p>{PROSE}</p>" for _ in range(3)) + "</article>"
    assert html_mincut.main_text(deep, ODDS) == "\n\n".join([PROSE.strip()] * 3)
    alone = "<div class='has-note'><p>Yes.</p></div>".join(f"<p>{PROSE}</p>" for _ in range(3))
    assert html_mincut.main_text(f"<main>{alone}</main>", ODDS).count("Yes.") == 2


def test_deep_nesting_stays_linear():
    import time
    t0 = time.time()
    page = "<div>" * 60_000 + "<p>" + PROSE + "</p>" + "</span>" * 60_000 + "<b>" * 20_000 + "<td>x" * 5
    bs = html_mincut.blocks_of(page)
    assert PROSE.strip() in [b.text for b in bs] and time.time() - t0 < 20
