"""Operators for training text: special cases, brute force, round trips, held-out accuracy."""

from __future__ import annotations

import base64
import io
import itertools
import os
import random
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fieldloom.llm import ann, chat, decontam, language, neardup, packing, quality, queries, toxicity, url_filter, warc
from fieldloom.llm.common import fold

SF = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")
LONG = "the of and to in " * 30_000


def odd_docs(spark):
    """Nulls, empty, white, very long and repeated texts, and columns whose names clash with results."""
    rows = [(None, "a short text", "x"), (1, None, "x"), (2, "", "x"), (3, "  \n ", "x"), (4, LONG, "x"), (5, "some words that stand here twice", None), (5, "some words that stand here twice", None), (6, "12345 !!", "x"), (7, "é́ 😀".encode("utf-16", "surrogatepass").decode("utf-16"), "x")]
    return spark.createDataFrame([(*r, "clash", 1.0, 7) for r in rows], "doc_id long, text string, lang string, host string, score double, class_id long")


# 1 ------------------------------------------------------------------------------------------------------------


def plain_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def best_place(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return min(row)


def test_edit_matching_is_brute_force():
    rng = random.Random(0)
    items = ["".join(rng.choice("abcd ") for _ in range(rng.randint(30, 60))).strip() for _ in range(12)]
    matcher = decontam.Matcher(items, 0.15)
    hits = 0
    for _ in range(150):
        item, near = rng.randrange(12), None
        near = list(items[item])
        for _ in range(rng.randint(0, 12)):
            at = rng.randrange(len(near))
            near[at : at + 1] = rng.choice([[], ["x"], [near[at], "y"]])
            near = near or ["z"]
        text = "".join(rng.choice("abcd ") for _ in range(40)) + "".join(near) + "".join(rng.choice("abcd ") for _ in range(40))
        got = {m[0]: m for m in matcher.matches(text)}
        for i, x in enumerate(items):
            least = best_place(x, text)
            assert (i in got) == (least <= matcher.budgets[i])
            if i in got:
                hits += 1
                assert got[i][1] == least == plain_distance(x, text[got[i][2] : got[i][3]])
    assert hits > 50


def test_contamination_of_odd_rows(spark):
    items = spark.createDataFrame([(1, "Some words, that stand HERE twice"), (2, None), (3, ""), (None, "some words that stood here twice"), (4, "short")], "item_id long, text string")
    got = decontam.contamination(odd_docs(spark), items).collect()
    assert Counter((r.doc_id, r.item_id, r.distance) for r in got) == {(5, 1, 0): 2, (5, None, 2): 2, (None, 4, 0): 1}
    assert decontam.clean(odd_docs(spark), items).count() == 6
    assert decontam.contamination(odd_docs(spark).limit(0), items).count() == 0
    assert decontam.contamination(odd_docs(spark), items.limit(0)).count() == 0


def test_short_items_occur_as_whole_words():
    matcher = decontam.Matcher(["to be", "\u4e2d\u6587", "cat"], 0.08, decontam.LEAST)
    assert matcher.matches("whether to be or not") == [(0, 0, 8, 13)]
    assert matcher.matches("into bear concatenate cats") == []
    assert matcher.matches("\u5b57\u4e2d\u6587\u5b57 a cat") == [(1, 0, 1, 3), (2, 0, 7, 10)]


# 2 ------------------------------------------------------------------------------------------------------------


def test_signatures_agree_as_often_as_weighted_sets_are_alike():
    rng = np.random.default_rng(1)
    element = np.arange(60, dtype=np.uint64)
    a = rng.uniform(0.2, 4, 60)
    b = a * rng.uniform(0.4, 1.4, 60)
    sets = neardup.dart_signatures(np.repeat([0, 1], 60), np.tile(element, 2), np.concatenate([a, b]), 2, 3000)
    assert (sets[0] == sets[1]).mean() == pytest.approx(neardup.similarity(element, a, element, b), abs=0.03)
    alone = neardup.dart_signatures(np.zeros(60, int), element, a, 1, 3000)
    assert (alone[0] == sets[0]).all()  # what else is in the batch doesn't count


def brute_classes(rows, size=5, least=0.8):
    shingler = neardup.Shingler(size, "presence")
    sets = []
    for _, text in rows:
        sets.append(set(shingler.sets([text or ""])[1].tolist()))
    top = list(range(len(rows)))

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    places = defaultdict(list)
    for i, (_, text) in enumerate(rows):
        if text is None:
            continue
        common = Counter(j for s in sets[i] for j in places[s])
        same = [j for j in range(i) if rows[j][1] == text]
        for j in same + [j for j, n in common.items() if n / (len(sets[i]) + len(sets[j]) - n) >= least]:
            top[find(i)] = find(j)
        for s in sets[i]:
            places[s].append(i)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[find(i)].append(rows[i][0])
    return {x: min(g) for g in groups.values() for x in g}


def test_classes_are_brute_force(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("abcdefghij") + rng.choice("aeiou") + rng.choice("rstlnm")
    rows = []
    for _ in range(25):
        base = [word() for _ in range(rng.choice([6, 40, 120]))]
        for _ in range(rng.randint(1, 6)):
            near = list(base)
            for _ in range(rng.randint(0, 4)):
                near[rng.randrange(len(near))] = word()
            rows.append((len(rows), " ".join(near)))
    rows += [(len(rows), ""), (len(rows) + 1, ""), (len(rows) + 2, None), (len(rows) + 3, None), (len(rows) + 4, "one two")]
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_classes(rows)
    assert sum(got[k] != want[k] for k in want) <= 1  # a pair just at the threshold may miss all bands once in 30,000


def test_links_that_no_center_shows(spark):
    """a-b and b-c are alike, a-c aren't; whichever is the center, all are one class."""
    words = [f"w{i}" for i in range(400)]
    step = lambda k: " ".join(words[k : k + 300])
    rows = [(i, step(i * 20)) for i in range(5)]
    got = {r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0}


def alike_in_family(rows):
    """Classes of ``rows`` by the similarity of every pair, for texts without copies."""
    sets = [set(neardup.Shingler(5, "presence").sets([text])[1].tolist()) for _, text in rows]
    counts = Counter(s for x in sets for s in x)
    column = {s: i for i, s in enumerate(s for s, n in counts.items() if n > 1)}
    held = np.zeros((len(rows), len(column)), np.float32)
    for i, x in enumerate(sets):
        held[i, [column[s] for s in x if s in column]] = 1
    both, size = held @ held.T, np.array([len(x) for x in sets])
    alike = np.triu(both / (size[:, None] + size - both) >= 0.8, 1)
    assert 0.74 < np.median(both / (size[:, None] + size - both)) < 0.76
    top = list(range(len(rows)))
    for i, j in zip(*np.nonzero(alike), strict=True):
        top = [top[i] if x == top[j] else x for x in top]
    least = {}
    for (doc_id, _), x in zip(rows, top, strict=True):
        least[x] = min(least.get(x, doc_id), doc_id)
    return {doc_id: least[x] for (doc_id, _), x in zip(rows, top, strict=True)}


def test_pairs_inside_a_family_are_brute_force(spark):
    rng = random.Random(7)
    fresh = iter(range(10**6))
    passage = [f"p{i}" for i in range(124)]
    rows = []
    for pair in range(1100):  # two texts of 0.75 share the passage; the two of the first 300 pairs half of their ends, too
        half = [f"h{next(fresh)}" for _ in range(10)]
        for _ in range(2):
            end = (half if pair < 300 else [f"w{next(fresh)}" for _ in range(10)]) + [f"w{next(fresh)}" for _ in range(10 + rng.randint(-1, 1))]
            rows.append((len(rows), " ".join(passage + end)))
    want = alike_in_family(rows)
    assert len(set(want.values())) == 2200 - 300
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == want


@pytest.mark.parametrize("pairs", [600, 1500])
def test_near_copies_of_template_pages_are_linked(spark, pairs):
    """Pages of one template, 0.684 alike, each with one near copy of 0.811: every copy finds its page, nothing else."""
    fresh = iter(range(10**7))
    passage = " ".join(f"t{i}" for i in range(134))
    rows = []
    for pair in range(pairs):
        own = [f"w{next(fresh)}" for _ in range(30)]
        for _ in range(2):
            rows.append((len(rows), " ".join([passage, *own, *(f"w{next(fresh)}" for _ in range(16 if pair % 2 else 17))])))
    sets = [set(neardup.Shingler(5, "presence").sets([x])[1].tolist()) for _, x in rows[:8]]
    alike = lambda i, j: len(sets[i] & sets[j]) / len(sets[i] | sets[j])
    assert alike(0, 1) >= 0.8 and alike(2, 3) >= 0.8 and alike(0, 2) < 0.7
    got = {r.doc_id: r.class_id for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert got == {i: i // 2 * 2 for i in range(2 * pairs)}


def test_one_of_each_keeps_whole_rows(spark):
    """Columns named like the operator's own, repeated rows, a third of all rows the same text, null ids and texts."""
    rows = [(i, "the same words stand here again and again", f"s{i}", 1, 2.0) for i in range(40)]
    rows += [(i, f"another text {i} has its own words and number {i}", "x", 1, 2.0) for i in range(40, 80)] + [(50, "another text 50 has its own words and number 50", "y", 1, 2.0)]
    rows += [(None, "the same words stand here again and again", "x", 1, 2.0), (None, "only null ids have this one text", "x", 1, 2.0), (7, None, "x", 1, 2.0), (7, None, "x", 1, 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string, _row int, label double")
    got = neardup.one_of_each(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text is None) for r in got.collect()) == Counter([(0, False), *((i, False) for i in range(40, 80)), (None, False), (7, True), (7, True)])
    assert neardup.one_of_each(docs.limit(0)).count() == 0


def test_first_shingles_meet_whatever_the_weights():
    rng = np.random.default_rng(2)
    met = 0
    for _ in range(3000):
        keys = np.arange(rng.integers(1, 90), dtype=np.uint64)
        rank = rng.permutation(len(keys) + 30)
        a, b = keys[rng.random(len(keys)) < 0.97], np.concatenate([keys[rng.random(len(keys)) < 0.95], np.arange(len(keys), len(keys) + rng.integers(0, 9), dtype=np.uint64)])
        wa, wb = (rng.integers(1, 4, len(keys) + 30) if rng.random() < 0.5 else np.ones(len(keys) + 30) for _ in range(2))
        wb = wa if rng.random() < 0.5 else wb
        wa, wb = wa[a.astype(int)].astype(float), wb[b.astype(int)].astype(float)
        if not len(a) or neardup.similarity(a, wa, b, wb) < 0.8:
            continue
        met += 1
        ka, ra, sa = neardup.first_shingles(a, wa, rank[a.astype(int)], 0.8)
        kb, rb, sb = neardup.first_shingles(b, wb, rank[b.astype(int)], 0.8)
        left, right = {int(k): (r, small) for k, r, small in zip(ka, ra, sa, strict=True)}, {int(k): (r, small) for k, r, small in zip(kb, rb, sb, strict=True)}
        enough = [k for k in left.keys() & right.keys() if min(left[k][0], right[k][0]) >= 0.8 / 1.8 * (wa.sum() + wb.sum()) - 1e-6]
        assert any((left[k][1] and wa.sum() <= wb.sum()) or (right[k][1] and wb.sum() <= wa.sum()) for k in enough)
    assert met > 300


def test_near_duplicates_of_odd_rows(spark):
    got = {(r.doc_id, r.class_id) for r in neardup.near_duplicates(odd_docs(spark)).collect()}
    assert {(1, 1), (2, 2), (5, 5), (None, None)} <= got
    assert neardup.near_duplicates(odd_docs(spark).limit(0)).count() == 0
    assert neardup.near_duplicates(odd_docs(spark), weighting="tf").count() == 9
    assert Counter(r.doc_id for r in neardup.one_of_each(odd_docs(spark)).collect())[5] == 1


# 3 ------------------------------------------------------------------------------------------------------------


def test_urls():
    assert url_filter.split_url("http://A.Example.ORG/x/Y?q=/#f") == ("a.example.org", "/x/Y")
    assert url_filter.split_url("https://h?x") == ("h", "") and url_filter.split_url("h/x") == url_filter.split_url(None) == ("", "")


def test_longest_rule_and_subdomains(spark):
    urls = ["http://example.org/en/12", "http://a.example.org/es/", "http://notexample.org/es/", "http://org/", "http://x.com/fr/1", "http://x.com/de/1", "http://x.com/frog", "http://x.net/", None, "nothing", "http://example.org"]
    pages = spark.createDataFrame([(i, u, "rule", "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string, verdict string")
    got = [(r.rule, r.verdict) for r in url_filter.judge_urls(pages, queries.URL_RULES).orderBy("page_id").collect()]
    assert got == [("example.org/en/1", "block"), ("example.org/es/", "block"), ("org/", "allow"), ("org/", "allow"), ("com/fr/", "allow"), ("com/de/", "block"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow"), (None, "allow")]
    assert url_filter.judge_urls(pages.limit(0), queries.URL_RULES).count() == 0
    assert url_filter.judge_urls(pages, []).where("verdict = 'allow'").count() == len(urls)


def test_colliding_digests_are_told_apart(tmp_path):
    same = lambda b: 7
    for name, data in url_filter.DigestArray.files([("block", "a.com/x"), ("allow", "b.com/y")], digest=same).items():
        (tmp_path / name).write_bytes(data)
    index = url_filter.DigestArray(str(tmp_path))
    assert index.judge([("a.com", "/x1"), ("b.com", "/y"), ("c.com", "/x")], digest=same) == [("a.com/x", False), ("b.com/y", True), (None, True)]


# 4 ------------------------------------------------------------------------------------------------------------


def turns(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, speaker string")


def test_rotation(spark):
    rows = [(1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|>"), (1, 2, "bob", "yo"), (2, 0, "system", "alone"), (None, 0, "cy", None), (3, None, None, "x"), (3, 1, "ann", "same"), (3, 1, "ann", "same")]
    got = {(r.conv_id, r.speaker, r.part): r for r in chat.rotate(turns(spark, rows)).collect()}
    assert set(got) == {(1, "ann", 0), (1, "bob", 0), (None, "cy", 0), (3, "", 0), (3, "ann", 0)}
    assert got[3, "ann", 0].first_turn is None
    r = got[1, "ann", 0]
    assert r.text == "<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>assistant\nhi < |im_end|><|im_end|>\n<|im_start|>user name=bob\nyo<|im_end|>\n"
    (a, b), = [map(int, s.split("-")) for s in r.mask.split(",")]
    assert r.text[a:b] == "hi < |im_end|><|im_end|>"
    assert got[3, "ann", 0].messages == 3 and len(got[3, "ann", 0].mask.split(",")) == 2
    assert chat.rotate(turns(spark, rows).limit(0)).count() == 0


def test_one_conversation_of_most_rows_is_rendered_in_equal_parts(spark):
    """One turn number for most messages, many of them equal; null conversations are one."""
    rng = random.Random(3)
    rows = [(None, 5, "ann", "same")] * 900 + [(None, rng.choice([5, 5, 6, None]), rng.choice(["bob", "system", "cy"]), f"m{rng.randrange(50)}") for _ in range(700)]
    rows += [(i, t, "ann" if t % 2 else "bob", f"t{t}") for i in range(200) for t in range(3)]
    rng.shuffle(rows)
    got = chat.rotate(turns(spark, rows).repartition(7)).collect()
    want = Counter()
    for conv in {r[0] for r in rows}:
        own = sorted((r[1:] for r in rows if r[0] == conv), key=lambda m: (m[0] is not None, m[0] or 0, m[1], m[2]))
        for speaker in {m[1] for m in own} - {"system"}:
            for part in range(-(-len(own) // chat.PART)):
                text, spans, some = "", [], own[part * chat.PART : (part + 1) * chat.PART]
                for _, role, said in some:
                    text += chat.START + ("assistant" if role == speaker else "system" if role == "system" else f"user name={role}") + "\n"
                    if role == speaker:
                        spans.append(f"{len(text)}-{len(text + said + chat.END)}")
                    text += said + chat.END + "\n"
                want[conv, speaker, part, some[0][0], len(some), text, ",".join(spans)] += 1
    assert Counter((r.conv_id, r.speaker, r.part, r.first_turn, r.messages, r.text, r.mask) for r in got) == want


def test_rotation_is_native(spark):
    plan = chat.rotate(turns(spark, [(1, 0, "a", "b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# 5, 6, 8 --------------------------------------------------------------------------------------------------------


def test_disguises_are_read():
    text = "you idiot and moron the stupid trash clown loser is that in here with this pathetic worthless " * 50 + "another line of plain words that are read as they stand " * 80
    model = toxicity.Model(toxicity.grams([text]))
    for shown, meant in {"1d10t": "idiot", "$tupid": "stupid", "m0r0n": "moron", "idiooooot": "idiot", "i.d.i.o.t": "idiot", "tr@sh!": "trash", "Plain,": "plain", "2024": "2024", "!!!": ""}.items():
        assert toxicity.restore(model, shown) == meant
    assert "idiot" in toxicity.Reader(model).apart(list("idiot"))


def test_viterbi_is_the_best_of_all_readings():
    model = toxicity.Model(toxicity.grams(["you idiot and moron the stupid trash clown loser is that in here with this pathetic worthless " * 20]))
    rng, tried = random.Random(4), 0
    for _ in range(400):
        word = "".join(rng.choice("ido0t1$a.e@rs!m") for _ in range(rng.randint(2, 7)))
        places = toxicity.lattice(word, apart=rng.random() < 0.3)
        best = {}
        for choice in itertools.product(*places):
            state, cost = 0, 0.0
            for letters, extra in choice:
                cost += extra
                for c in letters:
                    cost += float(model.cost.reshape(-1, toxicity.SIGNS)[state, toxicity.LETTER(c)])
                    state = (state * toxicity.SIGNS + toxicity.LETTER(c)) % toxicity.SIGNS**3
            cost += float(model.cost.reshape(-1, toxicity.SIGNS)[state, 0])
            read = "".join(x for x, _ in choice)
            best[read] = min(cost, best.get(read, cost))
        tried += len(best) > 3
        assert best[model.decode(places)] == pytest.approx(min(best.values()), abs=1e-4)
    assert tried > 100


def test_random_indexing_and_network_are_plain_loops():
    rng = np.random.default_rng(3)
    lengths = np.array([0, 5, 1, 9, 0, 3])
    rows = rng.integers(0, 12, lengths.sum())
    index = quality.index_vectors(12, 5)
    want, ends = np.zeros((12, quality.DIM)), np.cumsum(lengths)
    for end, n in zip(ends, lengths, strict=True):
        for i in range(end - n, end):
            for j in range(max(end - n, i - 2), min(end, i + 3)):
                if i != j:
                    for k in range(4):
                        want[rows[i], index[rows[j], k]] += 1 if k < 2 else -1
    assert (quality.contexts(rows, lengths, index, 2).reshape(-1, quality.DIM) == want).all()
    x, y = rng.normal(size=(200, 7)), rng.integers(0, 2, 200)
    net = quality.Network.fit(x + y[:, None], y)
    for row in x[:20]:
        z = [min(max((a - m) * s, -8), 8) for a, m, s in zip(row, net.mean, net.scale, strict=True)]
        hidden = [max(0.0, sum(a * w for a, w in zip(z, net.w1[:, j], strict=True)) + net.b1[j]) for j in range(net.w1.shape[1])]
        logit = sum(h * w for h, w in zip(hidden, net.w2, strict=True)) + net.b2
        assert net.predict(row[None])[0] == pytest.approx(1 / (1 + np.exp(-logit / net.temperature)), abs=1e-9)


HUGE = {"letters": "abcdefg" * 150_000, "one letter": "a" * 1_000_000, "signs": "a" + "#%&?" * 250_000 + "a", "signs at the end": "word" + "!?" * 500_000, "ideographs": "\u4e2d\u6587\uff0c\u5b57" * 250_000, "base64": base64.b64encode(bytes(random.Random(1).randrange(256) for _ in range(300_000))).decode()}


@pytest.mark.parametrize("kind", sorted(HUGE))
def test_unbroken_texts_take_linear_time(kind):
    model = toxicity.Model(toxicity.grams(["plain words that are read as they stand"]))
    judge = toxicity.Judge(0.0, np.zeros(0, np.int64), np.zeros(0))
    began = time.process_time()
    assert 0 <= toxicity.Scorer(model, judge).scores([HUGE[kind], "some words"])[0] <= 1
    words, shapes, _ = quality.tokens(quality.WordTable(quality.word_number), [HUGE[kind]])
    assert len(words) == 1
    assert time.process_time() - began < 40  # quadratic scans took minutes for a tenth of this


def test_long_hosts_ask_for_few_keys(tmp_path):
    for name, data in url_filter.DigestArray.files(queries.URL_RULES).items():
        (tmp_path / name).write_bytes(data)
    index = url_filter.DigestArray(str(tmp_path))
    host, path = "a." * 50_000 + "example.org", "/es/" + "x" * 100_000
    assert index.judge([(host, path), (host[:-4], path), ("a." * 50_000, "/fr/")]) == [("example.org/es/", False), (None, True), (None, True)]
    with pytest.raises(ValueError):
        url_filter.DigestArray.files([("block", "/no-host")])


def auc(score, label):
    order = np.argsort(score, kind="stable")
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    for v in np.unique(score):
        ranks[score == v] = ranks[score == v].mean()
    n = label.sum()
    return (ranks[label == 1].sum() - n * (n + 1) / 2) / (n * (len(label) - n))


def held(spark, name, column):
    got = queries.QUERIES[name](spark, SF).where("held_out")
    rows = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").select("score", column).toPandas()
    return auc(rows.score.to_numpy(), rows[column].to_numpy())


@needs_data
def test_held_out_quality(spark):
    assert held(spark, "op6_quality", "quality") > 0.95


@needs_data
def test_held_out_toxicity(spark):
    assert held(spark, "op5_toxicity", "toxic") > 0.75  # 15 toxic rows to learn from a language at this size; 1.0 at check_s


@needs_data
def test_held_out_language(spark):
    got = queries.op8_language_id(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).head()[0] > 0.98


def longest_matches(text: str, sample: str) -> int:
    phrases, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample and text[at : at + n] in sample:
            n += 1
        phrases, at = phrases + 1, at + n
    return phrases


def test_phrases_are_brute_force():
    rng = random.Random(2)
    samples = {k: ["".join(rng.choice(alphabet) for _ in range(600))] for k, alphabet in (("x", "aab "), ("y", "abb c"))}
    parser = language.Parser.fit(samples)
    texts = ["".join(rng.choice("abc  d") for _ in range(rng.randint(0, 300))) for _ in range(60)]
    got, _ = parser.phrases(texts)
    squeeze = lambda s: "".join(c for i, c in enumerate(s) if not (c == " " and i and s[i - 1] == " "))
    for text, row in zip(texts, got, strict=True):
        assert list(row) == [longest_matches(squeeze(text), squeeze(samples[k][0])) for k in ("x", "y")]


def test_alphabets_of_many_scripts_are_told_apart(spark, monkeypatch):
    """70 languages: 20 of ideographs, Greek and Cyrillic letters each; dense tables and sorted edges give the same phrases."""
    rng = random.Random(6)
    starts = [0x4E00 + 400 * i for i in range(20)] + [0x3B1] * 20 + [0x430] * 20 + [0x61] * 10
    words = [["".join(chr(start + rng.randrange(300 if start > 0x4000 else 24)) for _ in range(rng.randint(2, 6))) for _ in range(60)] for start in starts]
    text = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    samples = {f"l{k:02}": [text(k, 150)] for k in range(len(starts))}
    asked = [text(k, 40) for k in range(len(starts))]
    parser = language.Parser.fit(samples)
    assert parser.judge(asked)[0] == sorted(samples)
    dense = parser.phrases(asked)[0]
    monkeypatch.setattr(language, "DENSE", 0)
    assert (language.Parser.fit(samples).phrases(asked)[0] == dense).all()
    # a language of one very long text only is learned, too
    docs = spark.createDataFrame([(1, samples["l00"][0] * 200, "l00"), (2, asked[0], None), (5, asked[25], None)] + [(10 + i, text(25, 30), "l25") for i in range(20)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs, F.lit(True))).collect()}
    assert got[2] == "l00" and got[5] == "l25"


def test_language_of_odd_rows(spark):
    docs = odd_docs(spark)
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.identify(docs, language.fit(docs, F.lit(True))).collect()]
    assert len(got) == 9 and {d for d, p, s in got if p == "und" and s == 0} == {1, 2, 3, 6}
    assert {r.lang_pred for r in language.identify(docs, language.fit(docs, F.lit(False))).collect()} == {"und"}
    assert language.identify(docs.limit(0), language.fit(docs.limit(0), F.lit(True))).count() == 0
    assert language.known_language(docs, language.fit(docs, F.lit(True))).where("doc_id in (1, 2, 3, 6)").count() == 0


@pytest.mark.parametrize("labels", [0, 3])
def test_scores_of_odd_rows(spark, labels):
    docs = odd_docs(spark)
    sample = spark.createDataFrame([(4, 1), (5, 0), (6, 1)][:labels], "doc_id long, label int")
    vectors = quality.word_vectors(docs)
    scores = [r.score for r in quality.score(docs, vectors, quality.train(docs, sample, vectors)).collect()]
    model = toxicity.character_model(docs)
    scores += [r.score for r in toxicity.score(docs, model, toxicity.train(docs, sample, model)).collect()]
    assert len(scores) == 18 and all(0 <= s <= 1 for s in scores)
    empty = docs.limit(0)
    assert quality.score(empty, quality.word_vectors(empty), quality.train(empty, sample, vectors)).count() == 0


def test_folds_are_crc32(spark):
    got = spark.range(200).select("id", fold(F.col("id"), 4).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 4 for r in got)


# 7 ------------------------------------------------------------------------------------------------------------


def brute_nearest(ids, x, query, k):
    scores = [(-(x[query] * x[j]).sum(), ids[j]) for j in range(len(ids)) if ids[j] != ids[query]]
    return [i for _, i in sorted(scores)[:k]]


def test_neighbours_of_repeated_rows_are_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(60)]
    rows += [rows[0]] * 2 + [(0, rows[1][1])]
    same = [3.0, 3.0, 3.0, 3.0]
    rows += [(20, same)] * 4 + [(i, same) for i in range(100, 140)] + [(101, same)] * 7
    rows = [r for r in rows if r != rows[20]]
    got = defaultdict(list)
    for r in ann.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id").isin(0, 20, 101), 5).collect():
        got[r.query_id].append((r.rank, r.vec_id, round(r.score, 6)))
    for q in (0, 20, 101):
        want = []
        for v in {tuple(v) for i, v in rows if i == q}:
            ranked = sorted((-round(float(np.dot(v, w)), 6), i) for i, w in rows if i != q)[:5]
            want += [(n, i, -s) for n, (s, i) in enumerate(ranked, 1)]
        assert sorted(got[q]) == sorted(want)


@needs_data
def test_recall(spark):
    got = defaultdict(list)
    for r in queries.op7_nearest_neighbours(spark, "/root/testdata/sf0.1").orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.vec_id)
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], np.float64)
    wanted = {ids[i]: brute_nearest(ids, x, i, 20) for i in range(len(ids)) if ids[i] % 20 == 0}
    assert set(got) == set(wanted) and all(len(v) == 20 for v in got.values())
    assert np.mean([len(set(got[q]) & set(w)) / 20 for q, w in wanted.items()]) >= 0.9


def test_vectors_that_take_no_part_and_ties(spark):
    nan = float("nan")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [1.0, nan]), (80, [None, 1.0]), (100, []), (None, [1.0, 1.0]), (1, [1.0]), (7, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [2.0, 0.0]), (9, [-1.0, 0.0])]
    df = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<float>, rank int")
    got = ann.search(df, F.col("vec_id") % 20 == 0).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 5, 2.0), (0, 2, 3, 1.0), (0, 3, 7, 1.0), (0, 4, 9, -1.0)]
    assert ann.search(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_one_common_vector(spark):
    rows = [(i, [1.0, 0.5, 0.0]) for i in range(0, 900)] + [(900 + i, [float(np.cos(i)), float(np.sin(i)), 0.3]) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    x, ids = np.array([r[1] for r in rows]), [r[0] for r in rows]
    got = defaultdict(list)
    for r in ann.search(df, F.col("vec_id").isin(3, 1499), 5).orderBy("rank").collect():
        got[r.query_id].append(r.vec_id)
    assert got[3] == brute_nearest(ids, x, 3, 5) and len(got[1499]) == 5


# 9 ------------------------------------------------------------------------------------------------------------

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_words_give_the_ids_of_whole_texts():
    encoder = packing.Encoder(PATH)
    texts = ["", "It's 12ab, isn't it?!", "ΑΣ Σ İstanbul ÉCOLE é é", "a\x1cb <|endoftext|> c", "日本語 テキスト", "don'T 'S 's", "a b c\td"]
    texts += ["".join(random.Random(i).choice("ab'sT .,!1é́\n-_") for _ in range(200)) for i in range(60)]
    assert encoder.encode(texts) == [encoder._whole(t) for t in texts]


def test_ids_of_control_characters_and_latin_letters():
    encoder, rng = packing.Encoder(PATH), random.Random(8)
    points = [chr(i) for i in range(0x180)] + list("\u2028\u3000\u4e2d\u0301\u1e9e\U0001f600")
    texts = ["".join(rng.choice(points) if rng.random() < 0.5 else rng.choice("abc '.,1") for _ in range(rng.randint(1, 12))) for _ in range(20_000)] + ["a\x7fb", "\x1b[0m", "\x00"]
    assert encoder.encode(texts) == [encoder._whole(x) for x in texts]


def least_bins(lengths: tuple, room: int) -> int:
    """The fewest bins, by trying every set of pieces for the bin of the first one."""
    if not lengths:
        return 0
    first, rest = lengths[0], lengths[1:]
    found = {tuple(x for i, x in enumerate(rest) if not mask >> i & 1) for mask in range(1 << len(rest)) if first + sum(x for i, x in enumerate(rest) if mask >> i & 1) <= room}
    return 1 + min(least_bins(x, room) for x in found)


def test_packing_is_exact_where_the_bound_says_so():
    rng, certified = random.Random(9), 0
    for _ in range(60):
        lengths = [rng.randint(10, 70) for _ in range(rng.randint(1, 8))]
        want = least_bins(tuple(lengths), 100)
        bins, _ = packing.best_fit(np.array(lengths), 100)
        bound = packing.lower_bound(np.bincount(lengths, minlength=101), 100)
        assert bound <= want <= bins.max() + 1
        certified += bound == bins.max() + 1
    assert certified > 30


def test_bounds_hold_and_bins_fit():
    rng = np.random.default_rng(0)
    for n, high in ((1, 100), (60, 100), (400, 60), (300, 100)):
        lengths = rng.integers(1, high + 1, n)
        bins, offsets = packing.best_fit(lengths, 100)
        load = np.bincount(bins, weights=lengths)
        assert load.max() <= 100 and packing.lower_bound(np.bincount(lengths, minlength=101), 100) <= len(load)
        for b in range(len(load)):
            own = np.argsort(offsets[bins == b])
            assert (offsets[bins == b][own] == np.cumsum(lengths[bins == b][own]) - lengths[bins == b][own]).all()
    assert packing.lower_bound(np.bincount([51] * 7, minlength=101), 100) == 7
    assert packing.lower_bound(np.bincount([34] * 9, minlength=103), 102) == 3
    assert packing.lower_bound(np.bincount([35] * 9, minlength=103), 102) == 5


def test_packing_of_odd_rows(spark):
    docs = odd_docs(spark)
    rows = packing.pack(packing.pieces(docs, PATH)).collect()
    encoder = packing.Encoder(PATH)
    want = Counter()
    for r in docs.collect():
        ids = np.frombuffer(encoder._whole(r.text or ""), "<u4").tolist() + [1]
        for k in range(0, len(ids), 4096):
            want[r.doc_id, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == list(np.cumsum([0] + [n for _, n in own])[:-1]) and sum(n for _, n in own) <= 4096
    assert len(by) == packing.lower_bound(np.bincount([r.length for r in rows], minlength=4097), 4096)
    assert packing.pack(packing.pieces(docs.limit(0), PATH)).count() == 0


def test_partitions_exchange(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 50)
    rng = np.random.default_rng(4)
    rows = [(i, 0, 0, int(n), 0) for i, n in enumerate(rng.integers(1, 60, 600))]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, piece int, start long, length long, ids_crc32 long"), 100).collect()
    lengths = np.array([r[3] for r in rows])
    apart = sum(packing.best_fit(lengths[g::12], 100)[0].max() + 1 for g in range(12))
    together = packing.best_fit(lengths, 100)[0].max() + 1
    used = len({r.sequence_id for r in got})
    assert len(got) == 600 and sum({r.sequence_id: r.load for r in got}.values()) == lengths.sum()
    assert packing.lower_bound(np.bincount(lengths, minlength=101), 100) <= used <= together + 2 and used < apart


# 10 -----------------------------------------------------------------------------------------------------------


def archive(n=6):
    import zlib as z

    out = []
    for i in range(n):
        body = (f"page {i} " * 50).encode()
        pack = z.compressobj(6, z.DEFLATED, 31)
        out.append(pack.compress(warc.record(i, f"http://x/{i}", body, warc.bare_digest(body), None, False, "1970-01-01T00:00:00Z")) + pack.flush())
    return out


def read(data, **more):
    return list(warc.salvage(io.BytesIO(data), **more))


def test_whole_archives_read_back():
    got = read(b"".join(archive()), block=64)
    assert [g[0] for g in got] == ["record"] * 6 and [g[3]["page_id"] for g in got] == list(range(6))


def test_later_records_are_salvaged():
    parts = archive()
    starts = np.cumsum([0] + [len(p) for p in parts]).tolist()
    hurt = bytearray(b"".join(parts))
    hurt[starts[2] + 30 : starts[2] + 40] = b"\0" * 10
    for data, lost in ((bytes(hurt), {2}), (b"junk" + b"".join(parts), set()), (b"".join(parts)[:-5], {5}), (b"".join(parts[:3]) + b"WARC/1.0 but no" + b"".join(parts[3:]), set())):
        got = read(data, block=128)
        assert {g[3]["page_id"] for g in got if g[0] == "record"} == set(range(6)) - lost
        assert got[0][1] == 0 and got[-1][2] == len(data) and all(a[2] == b[1] for a, b in zip(got, got[1:], strict=False))
        assert [g for g in got if g[0] == "gap"]


def test_wrong_digests_and_plain_records():
    body = b"hello"
    good = warc.record(1, None, body, warc.bare_digest(body), None, False, "d")
    wrong = warc.record(2, None, body, "A" * 32, None, False, "d")
    got = read(good + wrong + good)
    assert [g[0] for g in got] == ["record", "gap", "record"] and got[1][3] == "wrong payload digest"


def test_round_trip_of_odd_pages(spark):
    rows = [(1, "u", None), (2, None, ""), (3, "a\r\nb", "same"), (9, "x", "same"), (9, "x", "same"), (None, "y", "same"), (5, "z", "é" * 100_000)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.round_trip(pages).collect())
    assert got == Counter([(1, 0, "revisit", 2), (2, 0, "response", None), (3, 4, "revisit", 9), (9, 4, "response", None), (9, 4, "response", None), (None, 4, "revisit", 9), (5, 200_000, "response", None)])
    assert Counter(r.record_type for r in warc.round_trip(pages, least_bytes=5).collect()) == {"response": 7}
    assert warc.round_trip(pages.limit(0)).count() == 0


# pipeline -----------------------------------------------------------------------------------------------------


@needs_data
def test_pipeline(spark):
    import corpus_pipeline

    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "quality", "near-duplicates", "decontamination", "packing"]
    rows = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    kept = {r.doc_id for r in rows}
    assert len({docs[i].text for i in kept}) == len(kept)
    items = [decontam.folded(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert not any(x in decontam.folded(docs[i].text) for i in kept for x in items)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert sum(labels.get(i) == 0 for i in kept) <= 3
    by = defaultdict(int)
    for r in rows:
        by[r.sequence_id] += r.length
    assert max(by.values()) <= 4096


def test_pipeline_of_odd_rows(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(2)
    words = {k: ["".join(rng.choice(x) for _ in range(rng.randint(3, 7))) for _ in range(80)] for k, x in {"aa": "abcdefgh", "zz": "stuvwxyz"}.items()}
    text = lambda k, n: " ".join(rng.choice(words[k]) for _ in range(n))
    rows = [(i, text("aa" if i % 2 else "zz", 40), "aa" if i % 2 else "zz") for i in range(60)]
    rows += [(100, rows[3][1], "aa"), (3, rows[3][1], "aa"), (None, rows[4][1], "zz"), (None, text("aa", 30), None), (101, None, "aa"), (102, "", "aa"), (103, "12 34 !!", None), (104, text("zz", 30_000), "zz")]
    kinds = "doc_id long, text string, lang string, source string, n_chars int, node string, label int, _row string"
    docs = spark.createDataFrame([(*r, "s", 1, "n", 2, "r") for r in rows], kinds)
    items = [(1, rows[7][1]), (2, None), (None, "")]
    for name, made in {"full": docs, "empty": docs.limit(0)}.items():
        made.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        spark.createDataFrame([(i, i % 3 > 0, None) for i in range(3)], "doc_id long, toxic boolean, quality int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/{name}/benchmark.parquet")
    got = corpus_pipeline.run(spark, f"{tmp_path}/full").collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter([i for i in range(60) if i != 7] + [None, 104])
    assert sum(r.doc_id == 104 for r in got) > 10
    assert corpus_pipeline.run(spark, f"{tmp_path}/empty").collect() == []


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_has_the_same_rows(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "pages", "conversations", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    got = con.execute(queries.ORACLE_SQL[name])
    columns = [c[0] for c in got.description]
    want = Counter(tuple(r[columns.index(c)] for c in sorted(columns)) for r in got.fetchall())
    assert Counter(tuple(r[c] for c in sorted(columns)) for r in queries.QUERIES[name](spark, SF).collect()) == want


def test_a_worker_keeps_one_model():
    from fieldloom.llm.common import held

    made = []
    make = lambda x: lambda: made.append(x) or x
    assert [held("a", make(1)), held("a", make(2)), held("b", make(3)), held("a", make(4))] == [1, 1, 3, 4]
    assert made == [1, 3, 4]


def test_letter_counts_of_odd_texts():
    texts = ["", "ab  c--d", "  ", "", "é.é", "1a1", ""]
    table = language.letter_table(["abcdé"])
    codes, lengths = language.classes(texts, table)
    assert lengths.tolist() == [0, 6, 1, 0, 3, 3, 0] and len(codes) == 13
    parser = language.Parser.fit({"x": ["abcdé" * 5]})
    assert parser.phrases(texts)[1].tolist() == [0, 4, 0, 0, 2, 1, 0]
