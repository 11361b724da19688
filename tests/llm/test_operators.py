"""The operators against plain versions of what they compute."""

import itertools
import random
import re
import time

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from logwarden.llm import (
    components, decontaminate, exact_dedup, html_extract, near_dedup, oracle, quality, queries, secret_scan,
    sentencepiece_codec, sharding, toxicity)


def frame(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t) for i, t in enumerate(texts)], "doc_id long, text string")


# exact dedup

def test_exact_dedup_compares_contents_under_one_digest(spark):
    docs = frame(spark, ["a b", "ab", "b a", "ba ", "c"])
    weak = {r.doc_id: (r.keep_id, r.group_size) for r in exact_dedup.exact_dedup(
        docs, digest=lambda c: F.lit("same")).collect()}
    assert weak == {0: (0, 2), 1: (0, 2), 2: (2, 2), 3: (2, 2), 4: (4, 1)}


# sharding

def test_smallest_capacity_and_cuts_against_brute_force(spark):
    rng = random.Random(5)
    for shards in (2, 4):
        texts = ["x" * rng.choice([1, 2, 3, 40]) + str(rng.randrange(30)) for _ in range(30)]
        rows = sharding.assign_shards(frame(spark, texts), shards).collect()
        by_text = {}
        for r in rows:
            by_text.setdefault(texts[r.doc_id], set()).add(r.shard)
        assert all(len(s) == 1 for s in by_text.values())
        for s in {r.shard for r in rows}:
            slots = sorted(r.slot for r in rows if r.shard == s)
            assert slots == list(range(len(slots)))
        groups = sharding.sized(frame(spark, texts)).groupBy("group_key").agg(F.sum("size")).orderBy("group_key").collect()
        sizes = [g[1] for g in groups]
        best = min(max(sum(sizes[a:b]) for a, b in zip((0, *cut), (*cut, len(sizes))))
                   for cut in itertools.combinations_with_replacement(range(len(sizes) + 1), shards - 1))
        loads = [sum(r.size for r in rows if r.shard == s) for s in range(shards)]
        assert max(loads) == best


def test_one_hot_group_leaves_no_shard_empty(spark):
    texts = ["hot"] * 400 + [f"text {i}" for i in range(600)]
    rows = sharding.assign_shards(frame(spark, texts), 8).collect()
    assert {r.shard for r in rows} == set(range(8))


# secrets

def test_weak_parts_need_their_complement(spark):
    key = "AKIA" + "B" * 16
    bare = "Zm9v" * 10
    texts = [f"id {key} then {bare} at https://host/path", f"only {bare} here", "see https://host/path",
             f"{key} " + "." * 300 + f" {bare}", f"login: alice99 {bare}", "secret=token:abcdef"]
    rows = {r.doc_id: r for r in secret_scan.digest_columns(secret_scan.scan_secrets(frame(spark, texts))).collect()}
    assert "bare" in rows[0].spans and "endpoint" in rows[0].spans and rows[0].n_access == 1
    assert rows[1].spans == "" and rows[2].spans == "" and rows[3].n_linked == 0
    assert rows[4].n_linked == 2 and rows[5].n_assign == 0


@pytest.mark.parametrize("gap", [198, 199, 200, 201, 202])
def test_links_at_the_reach_are_those_of_the_twin(spark, gap):
    """Parts of a credential at every distance around the reach, at and beside multiples of it."""
    hexed, login = "0123456789abcdef01234567", "login: alice99"
    texts = [f"{' ' * at}{first}{' ' * gap}{then}" for at in (0, 1, 150, 175, 176, 177, 199, 200, 201, 352, 377)
             for first, then in ((hexed, login), (login, hexed))]
    docs = frame(spark, texts)
    rows = secret_scan.digest_columns(secret_scan.scan_secrets(docs)).collect()
    db = duckdb.connect()
    db.register("documents", docs.toPandas())
    twin = db.sql(oracle.ORACLE["op5_secret_scan"]).select("doc_id", "spans", "n_linked").fetchall()
    assert sorted((r.doc_id, r.spans, r.n_linked) for r in rows) == sorted(twin)
    assert all(bool(r.n_linked) == (gap <= 200) for r in rows)


def test_very_many_matches(spark):
    text = "key " + "token=abcdef1 login: bob77\n" * 16_000
    started = time.monotonic()
    row = secret_scan.scan_secrets(frame(spark, [text])).first()
    assert time.monotonic() - started < 30
    want = [m.span() for m in re.finditer(r"token=abcdef1", text)]
    assert [(p.start, p.stop) for p in row.base] == want and len(row.linked) == 16_000


def test_base_spans_against_python(spark):
    rng = random.Random(3)
    parts = ["password", "TOKEN", "api_key", "apikey", ":", "=", " ", "'", '"', "abc", "abcdef12", "AKIA", "A" * 17,
             "é", "😀", "0123456789abcdef01234567", "\n", "=="]
    texts = ["".join(rng.choice(parts) for _ in range(40)) for _ in range(60)]
    got = {r.doc_id: r.base for r in secret_scan.scan_secrets(frame(spark, texts)).collect()}
    rules = [(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6),
             (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24)]
    for i, text in enumerate(texts):
        want = [(m.start(), rank, m.end()) for rank, (p, g, n) in enumerate(rules)
                for m in re.finditer(p, text) if len(m[g]) >= n]
        assert sorted((x.start, x.rank, x.stop) for x in got[i]) == sorted(want)


# near duplicates

def brute_components(texts, words, percent):
    sets = []
    for t in texts:
        w = t.split()
        sets.append({tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    root = list(range(len(texts)))
    for _ in texts:
        for a, b in itertools.combinations(range(len(texts)), 2):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                root[a] = root[b] = min(root[a], root[b])
    return root


def near_texts():
    rng = random.Random(11)
    base = [f"w{rng.randrange(500)}" for _ in range(60)]
    out = []
    for _ in range(24):
        t = list(base)
        for _ in range(rng.randrange(6)):
            t[rng.randrange(len(t))] = f"n{rng.randrange(1000)}"
        out.append(" ".join(t))
    return out + ["", "one", "one", "one two"] + [" ".join(f"z{rng.randrange(99)}" for _ in range(30)) for _ in range(8)]


@pytest.mark.parametrize("members", [512, 8])
def test_near_duplicates_against_all_pairs(spark, monkeypatch, members):
    monkeypatch.setattr(near_dedup, "MEMBERS", members)  # 8: clusters are cut into chunks
    texts = near_texts()
    rows = near_dedup.near_duplicates(frame(spark, texts), words=3, percent=85).collect()
    want = brute_components(texts, 3, 85)
    assert {r.doc_id: r.component_id for r in rows} == dict(enumerate(want))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(12)] + [(100, 101), (5, 5)], "a long, b long")
    found = {r.node: r.root for r in components.components(edges).collect()}
    assert found == {**{i: 0 for i in range(1, 13)}, 101: 100}


# decontamination

def test_edited_passages_are_found_and_others_not():
    rng = random.Random(2)
    letters = "abcdefghij "
    text = lambda n: "".join(rng.choice(letters) for _ in range(n))
    items = [(i, text(150)) for i in range(20)]
    index = decontaminate.build_index(items)
    for i, item in items:
        s = list(item)
        for _ in range(5):
            s[rng.randrange(len(s))] = rng.choice("xyz")
        host = text(400) + " " + "".join(s) + " " + text(400)
        found = decontaminate.matches(index, host)
        assert i in {m[0] for m in found}
        assert decontaminate.matches(index, text(1000)) == []


def test_banded_alignment_against_full_table():
    rng = random.Random(4)
    for _ in range(60):
        segment = np.array([rng.randrange(4) for _ in range(24)])
        codes = np.concatenate((np.array([rng.randrange(4) for _ in range(10)]), segment, [1, 2, 3]))
        for _ in range(2):
            codes = np.delete(codes, 12 + rng.randrange(10))
        row = np.zeros(len(codes) + 1, int)
        for c in segment:
            new = np.empty_like(row)
            new[0] = row[0] + 1
            for j, d in enumerate(codes):
                new[j + 1] = min(row[j] + (c != d), row[j + 1] + 1, new[j] + 1)
            row = new
        got = decontaminate.aligned(segment, codes, 9, 4)
        assert (got[0] if got else 5) == min(int(row.min()), 5)


# SentencePiece

def test_viterbi_against_all_segmentations():
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    table = sentencepiece_codec.load_pieces()
    codec = sentencepiece_codec.Codec(table)
    score = {}
    for i in range(len(model)):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            score[model.id_to_piece(i)] = model.get_score(i)
    for word in ["the", "and", "internationally", "schön", "a日b", "zzzzzz"]:
        text = "▁" + word
        best = [0.0] + [float("-inf")] * len(text)
        for end in range(1, len(text) + 1):
            for begin in range(end):
                piece = text[begin:end]
                s = score.get(piece, table.unknown_score if end - begin == 1 else float("-inf"))
                best[end] = max(best[end], best[begin] + s)
        ids = codec.encode([word])[0]
        unknown = sum(c not in score for c in text) * table.unknown_score
        got = sum(model.get_score(int(i)) for i in ids if not model.is_byte(int(i))) + unknown
        assert got == best[-1] and codec.decode(ids) == word
    long = "ab" * 500 + "日"
    words = [long[:60], long]
    assert [codec.decode(x) for x in codec.encode(words)] == words


# models

def test_held_out_quality_and_toxicity(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    known = labels.join(docs, "doc_id").select("doc_id", "text")
    for scores, column, least in ((quality.score_quality(known, labels), "quality", 0.97),
                                  (toxicity.score_toxicity(known, labels), "toxic", 0.97)):
        hits = scores.join(labels, "doc_id").where("held_out").select(
            F.avg((F.col("predicted") == F.col(column)).cast("int"))).first()[0]
        assert hits > least


def test_automaton_against_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, c in enumerate(a, 1):
            row = _next(row, i, c, b)
        return row[-1]

    def _next(row, i, c, b):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        return new

    rng = random.Random(9)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randrange(1, 8))) for _ in range(2))
        machine = toxicity.Automaton(a, 2)
        state = machine.start()
        for c in b:
            state = machine.step(state, c)
        assert machine.accepts(state) == (distance(a, b) <= 2)


def test_misspelled_words_of_a_family():
    counts = {"idio*": (60, 0), "f*ck": (20, 0), "fool": (20, 0)}
    lexicon = toxicity.Lexicon(counts, 100, 1000, members={"idiot": "idio*", "idiotic": "idio*", "idiots": "idio*"})
    for word in ("idoit", "idito", "iidot", "idiiot", "idot", "idi0t", "1d1ot", "idoitic", "1diotic"):
        assert lexicon.match(word) == ("idio*", True), word
    assert lexicon.match("idiotisch") == ("idio*", False) and lexicon.match("f*ck") == ("f*ck", False)
    assert lexicon.match("idio*x") == ("idio*", False)
    assert lexicon.match("audio") is None and lexicon.match("radiot") is None and lexicon.match("idea") is None
    scorer = toxicity.Scorer(lexicon)
    assert scorer.features("what an idoit once")[0] == scorer.features("what an idiot once")[0] > 0


def test_lexicon_keeps_words_of_a_family_as_targets(spark):
    rng = random.Random(2)
    filler = ["river", "stone", "window", "garden", "yellow", "market", "letter"]
    rows = [(" ".join(rng.choices(filler, k=12) + [rng.choice(["idiot", "idiots", "idiotic"])] * (i % 2)), i % 2) for i in range(300)]
    lexicon = toxicity.learn_lexicon(spark.createDataFrame(rows, "text string, label int"))
    assert lexicon.counts and all(t.startswith("idi") for t in lexicon.counts)
    assert lexicon.match("idoit")[1] and lexicon.match("iidots")[1]


def test_misspelled_terms_and_quotation():
    lexicon = toxicity.Lexicon({"idiot": (50, 0), "stupid": (40, 0), "lowe*": (20, 0)}, 100, 1000, frozenset({"stupin"}))
    assert lexicon.match("1diot") == ("idiot", True) and lexicon.match("stupiid") == ("stupid", True)
    assert lexicon.match("loweig") == ("lowe*", False)
    assert lexicon.match("stupin") is None and lexicon.match("ordinary") is None
    scorer = toxicity.Scorer(lexicon)
    assert scorer.features('He said "idiot" once')[1] < scorer.features("what an idiot once")[1]


# decontamination as a whole

def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_excerpts_of_fifty_characters_are_found(spark):
    """Verbatim excerpts from anywhere in an item, against a search for any of its 50-character pieces."""
    rng = random.Random(21)
    items = [(i, words(rng, 60)) for i in range(40)]
    docs, holds = [], set()
    for d in range(400):
        text, item = words(rng, 80), rng.randrange(40)
        if d % 2:
            source, length = items[item][1], rng.choice([50, 50, 55, 60, 80, 120])
            at = rng.randrange(len(source) - length)
            text, holds = f"{text[:200]} {source[at:at + length]} {text[200:]}", holds | {(d, item)}
        docs.append((d, text))
    plain = lambda t: "".join(map(chr, decontaminate.normalized(t)[0])).strip()
    brute = {(d, i) for d, t in docs for i, s in items for n in [plain(t)] for b in [plain(s)]
             if any(b[k:k + 50] in n for k in range(len(b) - 49))}
    found = {(r.doc_id, r.item_id) for r in decontaminate.find_contamination(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert brute <= holds and len(brute & found) >= 0.95 * len(brute) and len(found & holds) >= 0.95 * len(holds)
    assert found <= holds


def test_short_items_stand_between_word_edges(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 20)  # several blocks
    items = [(1, "Forty two"), (2, "yes!"), (3, "??"), (4, "Forty  two"), (5, "é")]
    texts = ["The answer: forty-two.", "forty twos", "Yes, forty\ntwo", "eyes", "YES", "", None, "caf é", "café"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id, r.start, r.stop) for r in decontaminate.find_contamination(docs, bench).collect()}
    assert found == {(0, 1, 12, 21), (0, 4, 12, 21), (2, 1, 5, 14), (2, 4, 5, 14), (2, 2, 0, 3), (4, 2, 0, 3), (7, 5, 4, 5)}
    kept = {r.doc_id for r in decontaminate.drop_contaminated(docs, bench).collect()}
    assert kept == {1, 3, 5, 6, 8}


# pages

def test_parts_that_are_not_the_article():
    page = ("<html><head><title>t</title><script>var a='<p>no</p>'</script></head><body><header>top</header>"
            "<div class='cookie-notice'>ok?</div><nav><ul><li>a<li>b</ul></nav><main><article><header><h1>Title</h1></header>"
            "<p>One &lt;two&gt;<br>three<p>Four <b>five</b><aside>side</aside><form>q<input></form>"
            "<div class=ad>buy</div><ul><li>x<li>y</ul></article><section id=comments><p>first!</p></section></main>"
            "<footer>end</footer></body></html>")
    assert html_extract.main_text(html_extract.parse(page)[0]) == "Title\n\nOne <two> three\n\nFour five\n\nx\n\ny"


def test_wrapper_learns_template_texts_of_a_host(spark):
    page = "<body><div class=x>Same on all</div><div class=y><p>text {0} one</p><p>text {0} two</p></div></body>"
    rows = [(i, "http://h/a", page.format(i)) for i in range(5)]
    found = html_extract.extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.text for r in found} == {f"text {i} one\n\ntext {i} two" for i in range(5)} and all(r.fits for r in found)


def test_alignment_makes_groups_and_options():
    one = html_extract.fold("ul li # /li li # /li /ul p # /p".split())
    two = html_extract.fold("ul li # /li /ul h2 # /h2 p # /p".split())
    wrapper = html_extract.align(one, two)
    assert ("+", ("li", "#", "/li")) in wrapper and ("?", ("h2",)) in wrapper
    assert html_extract.matches_wrapper(wrapper, one) and html_extract.matches_wrapper(wrapper, two)
    assert not html_extract.matches_wrapper(wrapper, html_extract.fold("ul /ul".split()))


def test_every_query_is_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}


def test_names_set_apart_no_article_and_not_most_of_a_page():
    def text(page):
        return html_extract.main_text(html_extract.parse(page)[0])

    body = "<article><div class='article-header'><h1>Title</h1></div><p>Text of the page.</p></article>"
    for name in ("layout has-sidebar", "no-sidebar", "search-result", "page-with-header", "sidebar", "search"):
        assert text(f"<div class='{name}'>{body}</div><p>other</p>") == "Title\n\nText of the page.", name
    assert text("<div class=sidebar>links</div><div class='site-header'>top</div><p>Text</p>") == "Text"
    assert text("<div class='post-comments'>so long a comment that it is most</div><p>Text</p>") == "Text"
    assert text("<div class=content><p>A text without any article</p></div><div class=related><article>Next</article></div>"
                ) == "A text without any article"
    assert text("<div class=widget><p>All there is of this page</p></div><p>x</p>") == "All there is of this page\n\nx"
    assert text("<div class=ad>ad</div><div class=comments><p>first comment</p></div>") == "first comment"
    assert text("<form id=aspnet><p>All in a form</p><nav>no</nav></form>") == "All in a form"
    assert text("<nav>only links</nav>") == "" and text("<div hidden>no</div>") == ""
