"""Operators on single rows, hosts and conversations: brute force, round trips and accuracy."""

import base64
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from arrivals_engine.llm import chat, html, langid, quality, urls, warc
from arrivals_engine.sources.scratch import scratch_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")

# --- quality rules ---


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    with_word = [x for x in text.split("\n") if WORD.search(x)]
    dup = sum(x in with_word[:i] for i, x in enumerate(with_word))
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def quality_rows(seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(300):
        junk = i % 10 == 0
        words = [f"w{rng.randrange(900)}" + ("$$#" if junk else "") for _ in range(rng.randrange(60, 120))]
        rows.append((i, " ".join(words[:30]) + "\n" + " ".join(words[30:]), "x"))
        labels += [(i, 0 if junk else 1)] * (1 + (i % 7 == 0))
    rows += [(900, None, "x"), (901, "", "x"), (902, "a b c " * 200, "x"), (None, "e\u2003b\x1cc\n\nx\nx\n " * 3, "x")]
    return [*rows, rows[3]], [*labels, (None, 1), (5, None), (77777, 1)]


def test_quality_counts_and_verdicts(spark):
    rows, labels = quality_rows(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string").repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    got = quality.verdicts(docs, marks).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:6])
    want = sorted([(i, *brute_counts(t)) for i, t, _ in rows], key=key)
    assert sorted([tuple(r)[:6] for r in got], key=key) == want
    for r in got:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and not (failed and r["kept"])
    good = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 300]
    assert all(r["kept"] == (r["doc_id"] % 10 != 0) for r in good)
    kept = quality.keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in got)


def test_threshold_is_the_same_in_any_order(spark):
    rows, labels = quality_rows(4)
    rows += [(i, f"{t} other words", x) for i, t, x in rows if i is not None and i % 3 == 0]
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string").repartition(1 + seed)
        found.add(quality.fit(docs, marks).threshold)
    assert len(found) == 1


def test_quality_without_labels_or_documents(spark):
    rows, labels = quality_rows(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert all(r["kept"] != r["base_failed"] for r in quality.verdicts(docs, none).collect())
    assert quality.verdicts(docs.limit(0), none).collect() == []


def test_odd_rows_score_higher():
    rng = np.random.default_rng(3)
    usual = rng.normal(0, 1, (500, 4))
    forest = quality.grow_forest(usual, 100, 256, 1)
    odd = np.array([[6.0, 6, 6, 6], [-7, -7, -7, 0]])
    assert forest.scores(odd).min() > np.quantile(forest.scores(usual), 0.98)
    scores, good = np.array([0.1, 0.2, 0.8, 0.9]), np.array([True, True, True, False])
    assert quality.calibrated(scores, good, 0.0) == 0.9
    assert quality.calibrated(scores, ~good, 0.0) == np.inf


# --- URL filters ---

RULES = [
    urls.Rule("allow", "com", "/"),
    urls.Rule("block", "bad.com", "/en/"),
    urls.Rule("block", "net", "/x/"),
]


def test_addresses_and_rules(spark):
    given = [
        ("http://A.bad.COM/en/P?q=/x#f", "a.bad.com", "/en/P", "bad.com/en/", "block"),
        ("https://bad.com", "bad.com", "", None, "allow"),
        ("x://bad.com?en/", "bad.com", "", None, "allow"),
        ("http://notbad.com/en/#a", "notbad.com", "/en/", "com/", "allow"),
        ("http://É.com/É", "É.com", "/É", "com/", "allow"),
        ("no scheme", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("a://b.net/x/http://c.com/", "b.net", "/x/http://c.com/", "net/x/", "block"),
        ("://", "", "", None, "allow"),
    ]
    rows = [(i, u, None if i % 2 else "<p>", "own") for i, (u, *_) in enumerate(given)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = {r["page_id"]: r for r in urls.judged(pages, RULES).collect()}
    for i, (_, host, path, rule, _) in enumerate(given):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule)
    assert [got[i]["verdict"] for i in (0, 3, 5, 6, 7)] == ["block", "allow", "allow", "allow", "block"]
    assert urls.judged(pages.limit(0), RULES).collect() == []


def brute_rank(edges, seeds, rounds=12, damping=0.85):
    out = Counter()
    for a, _ in edges:
        out[a] += edges[a, _]
    rank = dict(seeds)
    for _ in range(rounds):
        moved = Counter()
        for (a, b), n in edges.items():
            moved[b] += damping * rank.get(a, 0) * n / out[a]
        rank = {h: moved[h] + (1 - damping) * seeds.get(h, 0) for h in {*moved, *seeds}}
    return rank


def test_trust_and_distrust_spread_over_links(spark):
    link = lambda *hosts: "".join(f'<a href="http://{h}/p">' for h in hosts)
    rows = [
        (1, "http://good.com/", link("fine.org", "fine.org", "other.org")),
        (2, "http://a.evil.net/x/1", link("good.com")),
        (3, "http://farm.org/", link("a.evil.net", "A.evil.net") + '<a href="/own">'),
        (4, "http://fine.org/", None),
        (5, "http://far.org/", link("farm.org")),
        (6, "http://lonely.org/", ""),
        (7, "http://far.org/", link("farm.org")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r for r in urls.judged(pages, RULES).collect()}
    verdicts = {i: r["verdict"] for i, r in got.items()}
    assert verdicts == {1: "allow", 2: "block", 3: "block", 4: "allow", 5: "block", 6: "allow", 7: "block"}
    edges = {
        ("good.com", "fine.org"): 2, ("good.com", "other.org"): 1, ("a.evil.net", "good.com"): 1,
        ("farm.org", "a.evil.net"): 2, ("far.org", "farm.org"): 2,
        ("a.evil.net", "evil.net"): 1, ("evil.net", "a.evil.net"): 1,
    }
    trust = brute_rank(edges, {"good.com": 1.0})
    distrust = brute_rank({(b, a): n for (a, b), n in edges.items()}, {"a.evil.net": 1.0})
    for r in got.values():
        assert r["trust"] == pytest.approx(trust.get(r["host"], 0), abs=1e-9)
        assert r["distrust"] == pytest.approx(distrust.get(r["host"], 0), abs=1e-9)


def test_unrelated_pages_do_not_change_verdicts_and_far_hosts_have_a_rank(spark):
    link = lambda host: f'<a href="http://{host}/p">'
    rows = [(0, "http://evil.net/x/1", ""), (1, "http://h1.org/", link("evil.net"))]
    rows += [(k, f"http://h{k}.org/", link(f"h{k - 1}.org")) for k in range(2, 21)]
    rows += [(50, "http://good.com/", link("both.org")), (51, "http://both.org/", link("evil.net") + link("x.org"))]
    schema = "page_id long, url string, html string"
    few = spark.createDataFrame(rows, schema)
    other = spark.range(100, 300_100).selectExpr("id", "'http://spam.net/x/' AS url", "'' AS html")
    more_good = spark.range(100, 200_100).selectExpr("id", "'http://fine.com/' AS url", "'' AS html")
    verdicts = lambda pages: {r["page_id"]: r["verdict"] for r in urls.judged(pages, RULES).where("page_id < 100").collect()}
    alone = verdicts(few)
    assert all(alone[k] == "block" for k in range(21))
    assert verdicts(few.union(other)) == alone
    assert verdicts(few.union(more_good)) == alone


# --- HTML extraction ---


def test_article_without_furniture(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Menu</ul></nav>"
        '<header>Top</header><div class="ad">Buy</div><article><header><h1>Head&amp;line</h1></header>'
        "<script>var a='</p>';</script><p>One<br>two <b>bold</b>\n&nbsp;x<p>Un<!-- no -->closed &lt;p&gt;"
        '<aside>Side</aside><div class="comments"><p>Reader</p></div><ul><li>a<li>b</ul>'
        "<form>Mail</form></article><footer>&copy;</footer></body>"
    )
    want = "Head&line\n\nOne two bold x\n\nUnclosed <p>\n\na\n\nb"
    rows = [(1, "http://h.com/1", page, "t"), (2, None, None, "t"), (3, "u", "", "t"), (None, "u", page, "t")]
    pages = spark.createDataFrame([*rows, rows[0]], "page_id long, url string, html string, text string")
    got = sorted(html.extracted(pages).collect(), key=str)
    assert [r["text"] for r in got] == [want, want, "", "", want]
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert html.extracted(pages.limit(0)).collect() == []


def test_template_drops_slots_that_never_change(spark):
    page = "<body><div class='top'>Site name</div><div class='text'><p>Story {0}</p><p>More {0}</p></div><div class='end'>Rights</div></body>"
    rows = [(i, f"http://h.com/{i}", page.format(i)) for i in range(5)] + [(9, "http://g.com/", page.format(9))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in html.extracted(pages).collect()}
    assert all(got[i] == f"Story {i}\n\nMore {i}" for i in range(5))
    assert got[9] == "Site name\n\nStory 9\n\nMore 9\n\nRights"
    frame = {r["host"]: r["frame"] for r in html.templates(urls.with_address(pages, "url")).collect()}
    assert {(t["token"], t["same"]) for t in frame["h.com"]} == {
        ("/body", True), ("/body/div.top", True), ("/body/div.text", True), ("/body/div.end", True),
    }


def test_template_of_nested_classes_judges_the_slots_of_all_pages(spark):
    links = "<div class='x'><a>Home</a><a>News</a></div><ul><li><i>About</i><li><i>Terms</i></ul>"
    article = (
        "<article><h1>Head {0}</h1><p>Story {0}</p><p>More {0}</p><div class='y'>Follow us</div>"
        "<dl><dt>Born</dt><dd>{0}</dd><dt>Seen</dt><dd>{0}</dd></dl></article>"
    )
    story = "Head {0}\n\nStory {0}\n\nMore {0}"
    record = "\n\nBorn\n\n{0}\n\nSeen\n\n{0}"
    top = "<body><div class='top'>{1}</div>" + links
    rows = []
    for i in range(20):
        rows.append((i, "http://art.com/", (top + article).format(i, "Site")))
        rows.append((100 + i, "http://div.com/", (top + article.replace("article", "div")).format(i, "Site" if i else "New")))
        rows.append((200 + i, "http://copy.com/", (top + article).format(7, "Site")))
        rows.append((300 + i, "http://copies.com/", "<body><p>One story<p>Its end"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {r["page_id"]: r["text"] for r in html.extracted(pages).collect()}
    for i in range(20):
        assert got[i] == got[100 + i] == (story + record).format(i)
        assert got[200 + i] == (story + "\n\nFollow us" + record).format(7)
        assert got[300 + i] == "One story\n\nIts end"


def test_nested_classes():
    def once(*tokens, n=True):
        keys = ("token", "up", "main", "named", "alike")
        return {"once": n, "tokens": [dict(zip(keys, t, strict=True)) for t in tokens]}

    row = ("/b/r", 2, False, False, 1.0), ("/b/r/l", 4, False, False, 1.0)
    cell = ("/b/r/c", 4, False, False, 0.1), ("/b/r/c/i", 6, False, False, 1.0)
    foot = ("/b/f", 2, False, False, 1.0)
    root = once(("/b", 0, False, False, 1.0), foot)
    # The row's slots never change, but those of the class nested in it do.
    assert sorted(html.fixed_slots([root, once(*row, n=False), once(*cell, n=False)])) == ["/b", "/b/f"]
    # A lone token is part of the slot around it, which changes with it.
    assert html.fixed_slots([root, once(cell[0], n=False)]) == ["/b", "/b/f"]
    lone = ("/b/f/x", 4, False, False, 0.1)
    assert html.fixed_slots([root, once(lone, n=False)]) == ["/b"]
    # Nothing changes but what is furniture by its name: copies.
    assert html.fixed_slots([root, once(("/b/n", 2, False, True, 0.1))]) == []


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<body class='single has-sidebar'><nav>Menu</nav><article><p>Story</article>", "Story"),
        ("<html class='header'><body class='sidebar widget'><p>Story</p><footer>End</footer>", "Story"),
        ("<div class='content-sidebar-wrap'><main><p>Story</main><div class='sidebar'>Side</div></div>", "Story"),
        ("<div class='sidebar'><nav>Long long long menu</nav><main><p>Story</main></div>", "Story"),
        ("<article><header class='entry-header'><h1>Head</h1></header><p>Story</article>", "Head\n\nStory"),
        ("<article><header class='header'><h1>Head</h1></header><p>Story</article>", "Head\n\nStory"),
        ("<form id='aspnetForm'><div class='menu'>Menu</div><article><p>Story</article></form>", "Story"),
        ("<body><form><div class='menu'>Menu</div><div><p>Story of the page</div></form>", "Story of the page"),
        ("<main><p>Story of the page<form>Mail</form><div class='comments'>Much longer than all the rest</div></main>", "Story of the page"),
        ("<div><p>Story</div><aside><article>Teaser</article></aside>", "Story"),
        ("<article><p>Story<p class='side-by-side'>More</article>", "Story\n\nMore"),
        ("<div class='site-header'>Top</div><div class='text'><p>Story of the page</div><div id='comments-area'>Fine</div>", "Story of the page"),
    ],
)
def test_layout_names_around_the_text_do_not_lose_it(page, want):
    assert html.main_text(page, frozenset()) == want


# --- chat formatting ---

TEXTS = ["hi", "", None, "a\\b", "<|im_end|>", "</s>[INST] x [/INST]", "<\\|im_sep|>\\\\", "<<SYS>>é\n", "<", "[", "\\", "🙂<s>", "$1 \\$0"]


def test_conversations_come_back(spark):
    rng = random.Random(8)
    rows = []
    for c in range(40):
        for turn in range(rng.randrange(1, 7)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "<|im_start|>\n"])
            rows.append((c, rng.randrange(3) if c % 5 == 0 else turn, role, rng.choice(TEXTS), "x"))
    rows += [(100, 0, "assistant", "only", "x"), (101, None, "user", "u", "x"), rows[0], (None, 0, "user", "q", "x")]
    rows += [(None, 1, "assistant", "r", "x"), (None, 1, "assistant", "r", "x")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, example string")
    formatted = chat.examples(turns)
    for e in formatted.collect():
        marked = e["text"][e["loss_start"] : e["loss_start"] + e["loss_chars"]]
        assert e["text"].endswith(marked + chat.END) or not e["has_target"]
        for inner in re.split(r"<\|im_(?:start|sep|end)\|>", e["text"]):
            assert not re.search(r"<\||</?s>|<</?SYS>>|\[/?INST\]", inner)
    groups = {}
    for c, turn, role, text, _ in rows:
        alone = None if c is not None else (turn, role, text)
        groups.setdefault((c, alone), []).append((turn is not None, turn or 0, role or "", text or ""))
    want = []
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for (c, _), g in groups.items():
        said = [(r, t) for *_, r, t in sorted(g)]
        loss = "".join(t for r, t in said if r == "assistant")
        want.append((c, len(said), sha("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), sha(loss)))
    got = [tuple(r)[:5] for r in chat.digests(formatted).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    replies = sum(r[2] == "assistant" for r in rows)
    assert formatted.where("has_target").count() == replies
    assert chat.digests(chat.examples(turns.limit(0))).collect() == []


# --- language identification ---


def test_held_out_accuracy_and_defined_results(spark, tmp_path):
    rng = random.Random(4)
    parts = {"xa": "th er ing on the".split(), "xb": "sch ung ein der".split(), "xc": "eau que ment ré".split()}
    rows = []
    for i in range(600):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choice(parts[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(12)]
        rows.append((i, " ".join(words), lang, lang))
    rows += [(1000, None, "xa", "q"), (1001, "123 !?", "xa", "q"), (1002, "the ering", None, "q"), (None, "thering on", "xa", "q"), (1003, "", None, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {r["doc_id"]: r for r in langid.predictions(docs).collect()}
    held = [r for r in rows if r[0] is not None and r[0] < 600 and got[r[0]]["held_out"]]
    assert 150 < len(held) < 250
    assert np.mean([got[r[0]]["lang_pred"] == r[2] for r in held]) > 0.98
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 for i in (1000, 1001, 1003))
    assert got[1002]["lang_pred"] == got[None]["lang_pred"] == "xa" and not got[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in got.values())
    unlabelled = docs.withColumn("lang", docs["lang"].substr(9, 1)).where("lang is null")
    assert {r["lang_pred"] for r in langid.predictions(unlabelled).collect()} == {"und"}
    assert langid.predictions(docs.limit(0)).collect() == []


def test_small_languages_keep_their_own_words_and_none_is_left_out(spark):
    rng = random.Random(9)
    big = [(k, " ".join(f"ab{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}" for _ in range(30)), "big") for k in range(300)]
    small = [(1000 + k, f"zwq{chr(97 + k)} oyx", f"l{k:03}") for k in range(3)]
    many = [(2000 + k, f"{chr(97 + k % 26) * 3}{chr(97 + k // 26) * 3}", f"m{k:03}") for k in range(210)]
    schema = "doc_id long, text string, lang string"
    model = langid.fit(spark.createDataFrame(big + small, schema), max_words=40, max_grams=40)
    assert {"oyx", "zwqa", "zwqb", "zwqc"} <= set(model.words)
    assert len(set(model.unseen)) == 1
    rows = spark.createDataFrame(big + many, schema)
    model = langid.fit(rows)
    assert len(model.langs) == 211
    predictor = langid.Predictor(model)
    assert all(predictor.predict(text)[0] == lang for _, text, lang in many)


def test_unseen_words_fall_back_to_shorter_grams():
    one, two = np.array([-1.0, -2.0]), np.array([-3.0, -1.0])
    model = langid.Model(["a", "b"], {"known": one}, {"zz": two, "z": one}, np.array([-9.0, -9.0]))
    assert model.of_word("known") is one
    assert (model.of_word("xzzx") == two).all()
    assert (model.of_word("xzx") == one).all()
    assert (model.of_word("q") == [-9, -9]).all()


# --- WARC ---


def sha32(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.mark.parametrize("roll_bytes", [700, 1 << 20])
def test_archives_come_back_and_are_the_same_each_time(spark, roll_bytes):
    rng = random.Random(6)
    texts = [f"<p>{rng.random()}é\r\n\r\n</p>" * rng.randrange(1, 30) for _ in range(30)] + ["", None]
    rows = [(i, f"http://h.com/a b\r\n{i}", rng.choice(texts), "x") for i in range(80)]
    rows += [(5, None, texts[0], "x"), (5, None, texts[0], "x"), (None, "u", texts[1], "x"), (None, "u", "only here", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 string").repartition(4)
    listed, records = [], []
    for _ in range(2):
        folder = scratch_path(spark, "test_warc")
        listed.append(sorted(map(tuple, warc.write(pages, folder, roll_bytes=roll_bytes).collect())))
        records.append(warc.read(spark, folder).collect())
    assert listed[0] == listed[1]
    assert sum(n for _, n, *_ in listed[0]) == len(rows)
    assert roll_bytes > 700 or len(listed[0]) > 8
    first = {}
    for i, _, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    replies = Counter(r["payload_digest"] for r in records[0] if r["record_type"] == "response")
    assert replies == Counter(sha32(t) for t in {t or "" for _, _, t, _ in rows})
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"]) for r in records[0])
    assert got == Counter((i, len((t or "").encode()), sha32(t)) for i, _, t, _ in rows)
    by_digest = {sha32(t): i for t, i in first.items()}
    for r in records[0]:
        if r["record_type"] == "response":
            assert sha32(bytes(r["payload"]).decode()) == r["payload_digest"] and r["refers_to"] is None
            assert by_digest.get(r["payload_digest"]) == r["page_id"]
        else:
            assert r["refers_to"] == by_digest[r["payload_digest"]] and r["payload"] is None
        assert r["url"] is None or "\r" not in r["url"]


def test_small_payloads_are_all_responses_and_no_pages_no_files(spark):
    rows = [(1, "u", "aa"), (2, "u", "aa"), (3, "u", "bbbbb"), (4, "u", "bbbbb")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = scratch_path(spark, "test_warc")
    warc.write(pages, folder, min_bytes=3)
    got = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in warc.read(spark, folder).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}
    empty = scratch_path(spark, "test_warc")
    assert warc.write(pages.limit(0), empty).collect() == []
    assert warc.read(spark, empty).collect() == []


def test_archives_do_not_depend_on_partitions(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html")
    nameless = pages.where("page_id < 300").withColumn("page_id", F.lit(None).cast("long"))
    pages = pages.unionByName(nameless).unionByName(pages.where("page_id % 50 = 0"))
    listed = []
    for parts in (3, 7):
        folder = scratch_path(spark, "test_warc")
        dealt = pages.orderBy(F.rand(parts)).repartition(parts)
        made = warc.write(dealt, folder, roll_bytes=1 << 19, shard_bytes=1 << 20)
        listed.append(sorted(map(tuple, made.collect())))
    assert listed[0] == listed[1] and len(listed[0]) > 4
    assert sum(records for _, records, *_ in listed[0]) == pages.count()
    assert warc.read(spark, folder).count() == pages.count()
