"""Near copies, decontamination, components, page text, nearest neighbours and the pipeline against brute force."""

import itertools
import random
import re
import time

import numpy as np
import pytest

import corpus_pipeline
from cohortry.llm import decontamination, html_text, jaccard_join, nearest
from cohortry.llm.components import components
from cohortry.session import settle

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


# ---------------------------------------------------------------- near copies


def links_by_hand(rows, size=5, threshold=0.8):
    """(doc, links, class) of every row, by comparing all pairs."""
    sets = []
    for _, text in rows:
        w = split(text)
        n = min(size, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    links, up = [0] * len(rows), list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9:
            links[i] += 1
            links[j] += 1
            up[root(i)] = root(j)
    classes = {}
    for i, (doc, _) in enumerate(rows):
        classes.setdefault(root(i), []).append(doc)
    return sorted((repr(doc), links[i], repr(min((d for d in classes[root(i)] if d is not None), default=None))) for i, (doc, _) in enumerate(rows))


def near_rows(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 30, 80, 200]))]
        for _ in range(rng.choice([1, 2, 9])):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("block", [3, 2048])
def test_links_and_classes(spark, block):
    rows = near_rows(1)
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string"), block=block).collect()
    assert sorted((repr(r.doc_id), r.n_links, repr(r.class_id)) for r in got) == links_by_hand(rows)


@pytest.mark.parametrize("block", [3, 2048])
def test_links_of_rows_without_an_id(spark, block):
    # Every third row has no id, its exact copies neither; a whole class has none.
    rows = [(None if i % 3 == 1 else i, text) for i, text in near_rows(2)]
    chain = [f"c{i}" for i in range(40)]
    # The two ends are linked only through a middle without an id.
    rows += [(900, " ".join(chain)), (None, " ".join(chain[3:] + ["d0", "d1"])), (901, " ".join(chain[6:] + ["d0", "d1", "d2", "d3"]))]
    rows += [(None, "one row and its copy have no id at all here"), (None, "one row and its copy have no id, at all here")]
    got = jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id bigint, text string"), block=block).collect()
    want = links_by_hand(rows)
    assert sorted((repr(r.doc_id), r.n_links, repr(r.class_id)) for r in got) == want
    assert ("901", 1, "900") in want


def test_links_of_awkward_rows(awkward, empty):
    rows = [(r.doc_id, r.text) for r in awkward.collect() if r.doc_id is not None]
    got = jaccard_join.jaccard_join(awkward.where("doc_id is not null")).collect()
    assert sorted((repr(r.doc_id), r.n_links, repr(r.class_id)) for r in got) == links_by_hand(rows)
    assert jaccard_join.jaccard_join(awkward).count() == awkward.count()
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_pruning_never_gives_up_early():
    for n, least in jaccard_join.fewest_matches(0.8, 1e-6).items():
        assert 0 < least < 0.8 * n
    # The posterior by numerical integration.
    grid = np.linspace(0, 1, 20_001)
    density = grid**5 * (1 - grid) ** 11
    tail = density[grid >= 0.8].sum() / density.sum()
    assert (tail >= 1e-6) == (5 >= jaccard_join.fewest_matches(0.8, 1e-6)[16])


def test_exact_sizes_by_either_way():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 200, rng.integers(1, 150)).astype(np.uint64)) for _ in range(20)]
    rows, columns = (x.ravel() for x in np.indices((20, 20)))
    verifier = jaccard_join.Verifier(0.8, 1e-6)
    many = verifier.shared(sets, sets, rows, columns)
    few = [verifier.shared(sets, sets, rows[i : i + 1], columns[i : i + 1])[0] for i in range(400)]
    assert many.tolist() == few == [len(set(sets[i]) & set(sets[j])) for i, j in zip(rows, columns, strict=True)]


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)] + [(i, i + 1) for i in range(1000, 1100)] + [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i

    for a, b in edges:
        if a != b:
            up[max(root(a), root(b))] = min(root(a), root(b))
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: root(i) for a, b in edges if a != b for i in (a, b)}


def test_dropping_ids(spark, awkward):
    docs = spark.createDataFrame([(i % 50 if i < 98 else None, f"t{i}") for i in range(100)], "doc_id bigint, text string")
    ids = spark.createDataFrame([(3,), (7,), (999,)], "id bigint")
    assert sorted(r.text for r in jaccard_join.without_ids(docs, ids).collect()) == sorted(f"t{i}" for i in range(100) if i >= 98 or i % 50 not in (3, 7))
    once = jaccard_join.without_ids(docs, ids, spark.createDataFrame([(11,), (3,)], "id bigint"))
    assert once.count() == 95 and once.where("doc_id = 11").count() == 1


# ---------------------------------------------------------------- decontamination


def contaminated_by_hand(docs, items, size=10):
    wanted = {}
    for item, text in items:
        w = split(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            wanted.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = split(text), set(), set()
        for n in {len(k) for k in wanted}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit |= set(range(i, i + n))
                    found |= wanted[tuple(w[i : i + n])]
        out.append((repr(doc), len(w), sorted(hit), sorted(found)))
    return sorted(out)


def test_phrases(spark, awkward, empty):
    rng = random.Random(5)
    vocabulary = ["of", "the", "a", "to"] * 6 + [f"t{i}" for i in range(40)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 4, 10, 25])))) for i in range(30)] + [(3, "repeated item of the"), (None, "no id at all"), (31, None)]
    docs = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(80))]
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(words) + 1)
            words[at:at] = split(rng.choice(items)[1])
        docs.append((i // 2, " ".join(words)))
    docs += [(r.doc_id, r.text) for r in awkward.collect()]
    table = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = contaminated_by_hand(docs, [x for x in items if x[0] is not None])
    for block in (7, 50_000):
        found = decontamination.find_matches(decontamination.build_index(table), decontamination.test_windows(bench), block=block)
        assert sorted((repr(r.doc_id), r.n_words, list(r["places"]), list(r["items"])) for r in found.collect()) == want
    digest = decontamination.digest(found)
    assert digest.where("contaminated <> (n_hit > 0)").count() == 0
    assert decontamination.contamination(table, bench.where("false")).where("size(places) > 0").count() == 0
    assert decontamination.contamination(empty, bench).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "zebra x apple x x lemon"), (2, "lemon zebra apple"), (3, "zebra " + "x " * 30 + "apple lemon"), (4, "apple zebra")], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, "zebra apple lemon")], "item_id bigint, text string")
    found = {r.doc_id: (list(r["items"]), list(r["near_items"])) for r in decontamination.contamination(docs, items, reach=6).collect()}
    assert found == {1: ([], [9]), 2: ([], [9]), 3: ([], []), 4: ([], [])}


# ---------------------------------------------------------------- pages

PAGES = [
    ("<html><head><title>t</title></head><body><nav>menu</nav><article><h1>Head &amp; line</h1><p>One <b>bo</b>ld<br>two</p><div class='comments'>first!</div><p>End</article><footer>f</footer>", "Head & line\n\nOne bold two\n\nEnd"),
    ("<main><p>a &lt;b&gt; c&nbsp;d</p><aside>side</aside><form>name</form><ul><li>x<li>y</ul></main>", "a <b> c d\n\nx\n\ny"),
    ("<body><div id='cookie-notice'>cookies</div><p>plain page</p><script>if (a < b) '<p>'</script><style>p{}</style><!-- <p>no</p> -->", "plain page"),
    ("<article><header><h1>Kept</h1></header><p>text &#233;&eacute; &am</p><div hidden>no</div><p title=\"a > b\">more</p></article><div class=ad>buy</div><foo", "Kept\n\ntext éé &am\n\nmore"),
    ("", ""),
    (None, ""),
    ("no markup at all", "no markup at all"),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert html_text.main_text(page, None) == text


WRAPPED = [
    ('<div class="layout has-sidebar"><article><p>whole text</p></article></div>', "whole text"),
    ('<div id="page" class="no-comments"><p>whole text</p></div>', "whole text"),
    ('<article class="post category-social"><p>whole text</p></article>', "whole text"),
    ('<div class="sidebar"><article><p>whole text</p><div class="share-buttons">share</div></article></div>', "whole text"),
    ('<div class="comments"><main><p>whole text</p></main></div><p>other</p>', "whole text"),
    ('<article><p>whole text</p><ol class="comment-list"><li><article><p>first!</p></article></ol></article>', "whole text"),
    ('<body><form action="Default.aspx"><div><header>top</header><h1>Head</h1><p>whole text</p></div><footer>f</footer></form><p>end</p></body>', "Head\n\nwhole text\n\nend"),
    ("<body><form><p>whole text</p></form></body>", "whole text"),
    ("<body><p>whole text</p><form><p>your name</p></form></body>", "whole text"),
    ('<nav><article><p>menu</p></article></nav><div class="ads-container">buy</div><p>whole text</p>', "whole text"),
]


@pytest.mark.parametrize("page, text", WRAPPED)
def test_wrappers_do_not_take_the_article(page, text):
    assert html_text.main_text(page, None) == text


UNCLOSED = [
    ("<html><head><title>t</title><meta charset=utf-8><body><article><p>whole text</p></article>", "whole text"),
    ("<head><title>t <b>x</b></title><link rel=x><noscript><img src=x></noscript><p>whole text</p>", "whole text"),
    ("<head><script>if (a) '</p>'</script><style>p{}</style></head><title>t</title><p>whole text</p>", "whole text"),
    ("<p>one</p><svg viewBox='0 0 1 1'/><p>two</p><svg><text>no</text></svg><p>three</p>", "one\n\ntwo\n\nthree"),
    *((f"<p>one</p><{name} id=x><p>two</p>", "one\n\ntwo") for name in ("noscript", "template", "svg", "iframe", "object", "canvas", "select")),
    ("<p>one</p><object><p>two</p><object>no<p>no</p></object><p>three</p>", "one\n\ntwo\n\nthree"),
    ("<p>one <object>no<object>no</object>no</object>line</p><template><article>no</article></template>", "one line"),
    ("<header-line>own element</header-line><p>text</p><script-less>kept</script-less>", "own element\n\ntext\n\nkept"),
    ("<p>one</p><script>var a = '<p>no</p>'", "one"),
]


@pytest.mark.parametrize("page, text", UNCLOSED)
def test_unclosed_tags_do_not_take_the_page(page, text):
    assert html_text.main_text(page, None) == text


def test_host_repeats(spark):
    footer = "this very long line stands below each and every page of the host"
    rows = [(i, f"http://a.example/{i}", f"<div>unique text number {i} of this page here ok</div><div>{footer} {i}</div><div>Short one</div>") for i in range(5)]
    rows += [(10, "http://b.example/", f"<div>{footer}</div>"), (11, None, None), (12, "http://[broken", "<p>x</p>"), (10, "http://b.example/", f"<div>{footer}</div>")]
    rows += [(20 + i, f"http://c.example/{i}", f"<article><p>{footer}</p></article><div>Short one</div>") for i in range(2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for part in (2, 1024):
        found = html_text.extract(pages, part=part)
        got = sorted((r.page_id, r.text, r.n_chars) for r in found.collect())
        want = [(i, f"unique text number {i} of this page here ok\n\n{i}") for i in range(5)] + [(10, footer)] * 2 + [(11, ""), (12, "x"), (20, footer), (21, footer)]
        assert got == [(i, t, len(t)) for i, t in want]
    assert html_text.extract(pages.where("false")).count() == 0


def test_what_few_pages_share_stays(spark):
    quote = "a sentence of nine words that two pages quote"
    story = "the same story stands on this page and in its print version with another date"
    footer = "this very long line stands below each and every page of the host"
    rows = [(i, f"http://a.example/{i}", f"<p>{story}</p><p>date {i}</p>") for i in range(2)]
    rows += [(100 + i, f"http://b.example/{i}", f"<h2>Details</h2><p>text of page{i} alone</p>" + (f"<p>{quote}</p>" if i < 3 else "") + f"<p>{footer}</p><p>Top</p>") for i in range(80)]
    menu = "".join(f"<li>item {x}" for x in "abcd")
    rows += [(200 + i, f"http://c.example/{i}", f"<ul>{menu}</ul><p>page{i} own</p>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    for part in (7, 1024):
        got = {r.page_id: r.text for r in html_text.extract(pages, part=part).collect()}
        assert [got[i] for i in range(2)] == [f"{story}\n\ndate {i}" for i in range(2)]
        assert [got[100 + i] for i in range(80)] == [f"Details\n\ntext of page{i} alone" + (f"\n\n{quote}" if i < 3 else "") for i in range(80)]
        assert [got[200 + i] for i in range(3)] == [f"page{i} own" for i in range(3)]


def test_repeats_do_not_depend_on_parts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.choice([3, 12, 40]))) for _ in range(60)]
    pages = spark.createDataFrame([(i, f"http://h{i % 2}.example/", f"<div>{t}</div>") for i, t in enumerate(texts)], "page_id bigint, url string, html string")
    got = [sorted(r.run for r in html_text.repeated_runs(pages, part).collect()) for part in (1, 7, 1024)]
    assert got[0] == got[1] == got[2] and got[0]
    # As many distinct runs as stand in two different texts of a host.
    seen = {}
    for i, t in enumerate(texts):
        w = t.split()
        for a in range(max(1, len(w) - html_text.RUN + 1)):
            seen.setdefault((i % 2, tuple(w[a : a + html_text.RUN])), set()).add(t)
    assert len(got[0]) == sum(len(s) > 1 for s in seen.values())


def test_suffix_array():
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 30, 20)
    codes, ends = rng.integers(0, 3, lengths.sum()), np.repeat(np.cumsum(lengths), lengths)
    order, rank = html_text.suffix_array(codes, ends, 8)
    prefix = [tuple(codes[i : min(i + 8, ends[i])]) for i in range(len(codes))]
    assert [prefix[i] for i in order] == sorted(prefix)
    assert all((rank[i] == rank[j]) == (prefix[i] == prefix[j]) for i, j in itertools.combinations(range(60), 2))


# ---------------------------------------------------------------- nearest neighbours


def test_nearest_on_all_usable_vectors(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((12, 24))
    vectors = (centres[rng.integers(0, 12, 3000)] + 0.6 * rng.standard_normal((3000, 24))) * rng.uniform(0.5, 2, (3000, 1))
    vectors[100:130] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    bad = [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [None] + [1.0] * 23), (5080, [float("inf")] + [1.0] * 23), (5100, [1.0]), (None, [1.0] * 24), (5120, [])]
    table = spark.createDataFrame(rows + bad, "vec_id bigint, embedding array<double>").repartition(3)
    queries = table.where("vec_id % 20 = 0")
    found = nearest.nearest(table, queries, k=20, shard=700).collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert sorted(by) == list(range(0, 3000, 20))
    hit = 0
    for q, got in by.items():
        got.sort()
        scores = vectors @ vectors[q]
        best = [i for i in np.lexsort((np.arange(3000), -scores)) if i != q][:20]
        assert [g[0] for g in got] == list(range(1, 21)) and q not in [g[1] for g in got]
        assert all(s == pytest.approx(scores[i], abs=1e-9) for _, i, s in got)
        assert [(-s, i) for _, i, s in got] == sorted((-s, i) for _, i, s in got)
        hit += len({g[1] for g in got} & set(best))
    assert hit / (20 * len(by)) >= 0.9


def test_few_vectors(spark):
    table = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(5)], "vec_id bigint, embedding array<double>")
    found = nearest.nearest(table, table.where("vec_id = 0"), k=20).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in found] == [(i + 1, i + 1, 1.0) for i in range(4)]
    assert nearest.nearest(table.where("false"), table).count() == 0
    assert nearest.nearest(table, table.where("false")).count() == 0


def test_every_code_within_the_radius(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((500, 16))
    codes = nearest.learn(vectors, float(np.linalg.norm(vectors, axis=1).max()), 10, 0.95)
    shard = nearest.Shard(codes, np.arange(500), vectors)
    asked = codes.encode(vectors[:20], True)
    whole = nearest.distances(asked, shard.code)
    for radius in (0, 40, 77, 100, 256):
        query, row, apart = shard.within(asked, radius)
        assert set(zip(query.tolist(), row.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(whole <= radius)), strict=True))
        assert (whole[query, row] == apart).all()


# ---------------------------------------------------------------- pipeline


def test_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (9003, "12 34", None, None, 5), (None, "some words without an id", "en", "s", 9)], docs.schema)
    kept = docs.unionByName(odd).unionByName(docs.where("doc_id = 2"))
    before = {(r.doc_id, r.text) for r in kept.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = settle(stage(spark, kept, folder), name)
        assert kept.columns == docs.columns
        after = [(r.doc_id, r.text) for r in kept.collect()]
        assert set(after) <= before
        before = set(after)
        if name == "language_id":
            assert not {9001, 9002, 9003} & {i for i, _ in after} and len(after) >= 0.99 * docs.count()
        if name == "ngram_jaccard_join":
            assert len(after) == len(before)
            by = {}
            for i, links, group in links_by_hand(sorted((-1 if i is None else i, t) for i, t in before)):
                by.setdefault(group, []).append((i, links))
            assert all(len(v) == 1 for v in by.values())
        if name == "benchmark_decontamination":
            items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            assert not any(hit for _, _, hit, _ in contaminated_by_hand(after, items))
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, folder)
    assert {r.doc_id for r in packed.collect()} == {i for i, _ in before}
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("page", ["<div></span>" * 90_000, "<title>x" * 130_000, "<div><section><article>" * 45_000, "<a href=\"x>" * 95_000, "<svg>" * 200_000 + "</svg>", "<!-- <![CDATA[ <" * 65_000])
def test_long_broken_pages_take_linear_time(page):
    """About a megabyte each; a look through all open tags or to the page's end for each tag would take minutes."""
    began = time.process_time()
    html_text.main_text(page, None)
    assert time.process_time() - began < 4


def test_rows_that_share_an_id_or_have_none(spark):
    """Near copies and leaks go by row: a clean text stays though its id also stands on a copy or a leak, or it has no id."""
    folder = "/root/testdata/sf0.001"
    item = spark.read.parquet(f"{folder}/benchmark.parquet").where("size(split(text, ' ')) > 12").first().text
    rng = random.Random(12)
    clean = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(7)]
    rows = [
        (1, clean[0]), (1, clean[1]), (2, clean[0]), (2, clean[2]), (None, clean[3]), (None, clean[4]), (None, clean[0]), (3, clean[5]), (3, clean[5]),
        (4, clean[6] + " " + item), (4, clean[6]), (5, None), (5, ""), (None, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    kept = settle(corpus_pipeline.near_copy_stage(spark, docs, folder), "t-copies")
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    want = [(1, clean[0]), (1, clean[1]), (2, clean[2]), (None, clean[3]), (None, clean[4]), (3, clean[5]), (4, clean[6] + " " + item), (4, clean[6]), (5, None), (5, ""), (None, None)]
    assert got == sorted(want, key=repr) and kept.columns == docs.columns
    after = corpus_pipeline.decontamination_stage(spark, kept, folder)
    want.remove((4, clean[6] + " " + item))
    assert sorted(((r.doc_id, r.text) for r in after.collect()), key=repr) == sorted(want, key=repr)


def test_pipeline_of_nothing(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("false")
    for name, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, folder), name)
        assert docs.count() == 0


def test_vectors_whose_squares_leave_the_range(spark):
    rng = np.random.default_rng(5)
    small = rng.standard_normal((300, 8))
    for factor in (1e200, 1e-200):
        rows = [(i, (v * factor).tolist(), "x", 1.5) for i, v in enumerate(small)]
        table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, rank string, score double")
        found = nearest.nearest(table, table.where("vec_id % 50 = 0"), k=5).collect()
        assert len(found) == 30
    one = spark.createDataFrame([(1, [1e200, 0.0]), (2, [1.0, 1.0]), (3, [-1.0, 2.0])], "vec_id bigint, embedding array<double>")
    got = [(r["rank"], r.vec_id, r.score) for r in nearest.nearest(one, one.where("vec_id = 2"), k=5).collect()]
    assert sorted(got) == [(1, 1, 1e200), (2, 3, 1.0)]
