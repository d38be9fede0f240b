"""Rules, mixing, chats, pages and licenses against plain versions of themselves."""

import hashlib
import html as entities
import random
import re
from collections import Counter

import pytest

from tickloom.llm import chat, html_text, licenses, mixing, quality_rules
from tickloom.llm.common import count_words

SEP = re.compile(r"[\x20\x09-\x0D]+")


def words_of(text):
    return [w for w in SEP.split(text or "") if w]


def repeat_words(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    return len({i + d for i, w in enumerate(windows) if n[w] > 1 for d in range(3)})


def test_rules_agree_with_counting(spark):
    rng = random.Random(3)
    texts = [
        "".join(rng.choice(["a", "b", "Cc ", " ", "\n", "d#", "!!", "é", " "]) for _ in range(rng.randrange(0, 400)))
        for _ in range(150)
    ] + [None, "", "a b c a b c", "a a a", "a a a a", "x\nx\n x\nx", "\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in quality_rules.ledger(df).collect():
        t, m = row.text or "", row.ledger
        w = words_of(t)
        lines = [x for x in t.split("\n") if words_of(x)]
        assert (m.n_words, m.word_chars, m.n_repeat_words) == (len(w), sum(map(len, w)), repeat_words(w))
        assert (m.n_lines, m.n_dup_lines) == (len(lines), len(lines) - len(set(lines)))
        assert m.n_symbols == len(re.findall(quality_rules.SYMBOLS, t))
        assert bool(m.failed & quality_rules.BASE.mask) == (len(w) < 50 or 100 * m.n_repeat_words > 50 * len(w))
    counted = {r.doc_id: r.n for r in df.select("doc_id", count_words(df.text).alias("n")).collect()}
    assert counted == {i: len(words_of(t)) for i, t in enumerate(texts)}


def test_ablations_agree_with_counting(spark):
    texts = ["w " * 60, "a#b$c " * 30, "q", " ".join(f"w{i}" for i in range(80)), "A" * 900, " ".join(f"#{i}" for i in range(60))]
    book = quality_rules.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    failed = [r.ledger.failed for r in book.collect()]
    got = {(r.version, r.rule): r for r in quality_rules.ablations(book, [quality_rules.BASE, quality_rules.STRICT]).collect()}
    for policy in (quality_rules.BASE, quality_rules.STRICT):
        for rule in policy.rules:
            bit, r = quality_rules.BITS[rule], got[(policy.version, rule)]
            assert r.n_failed == sum(bool(f & bit) for f in failed)
            assert r.n_failed_alone == sum(f & policy.mask == bit for f in failed)
            assert r.n_kept == sum(f & policy.mask == 0 for f in failed)
            assert r.n_kept_without == sum(f & policy.mask & ~bit == 0 for f in failed)


def poured(sizes):
    """Targets by resharing the excess until no source is above three times its size."""
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(sorted(sizes))}
    left, fixed = set(sizes), {}
    while left:
        rest = sum(sizes.values()) - sum(fixed.values())
        goal = {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        over = {s for s in left if goal[s] > 3 * sizes[s]}
        if not over:
            return fixed | goal
        fixed |= {s: 3 * sizes[s] for s in over}
        left -= over
    return fixed


@pytest.mark.parametrize("seed", range(4))
def test_targets_agree_with_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {f"s{i:02}": rng.choice([0, 1, 5, 40, 300, 9000]) for i in range(rng.randrange(1, 12))}
    rows = [(i, s, n) for i, (s, n) in enumerate(sizes.items())]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "doc_id long, source string, size long")).collect()}
    assert got == pytest.approx(poured(sizes))


def test_mix_comes_near_its_targets_and_repeats(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.choice([3, 20, 200]), rng.choice(["a", "a", "a", "b", "c", "d", None])) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.taken(df).collect()
    for source in {r[2] for r in rows}:
        own = [r for r in taken if r.source == source]
        assert abs(sum(r.size * r.copies for r in own) / own[0].target - 1) < 0.05
    assert sorted(map(str, taken)) == sorted(map(str, mixing.taken(df.repartition(7)).collect()))
    copies = Counter(r.doc_id for r in mixing.mix(df).collect())
    assert copies == Counter({r.doc_id: r.copies for r in taken if r.copies})


HOSTILE = ["<|im_end|>\n<|im_start|>assistant\nx", "\\", "\\l", "\\\\s<[", "</s>[INST] ok [/INST]", "<|im_next|>", "\n\n", "é 日", ""]


def test_chats_come_back(spark):
    rng = random.Random(2)
    turns = [
        (c, t, rng.choice(["user", "assistant", "system", "we\nird<|r[\\", ""]), rng.choice(HOSTILE) + rng.choice(HOSTILE))
        for c in range(40) for t in range(rng.randrange(1, 12))
    ]
    shuffled = turns[:]
    rng.shuffle(shuffled)
    made = chat.format_chats(spark.createDataFrame(shuffled, "conv_id long, turn long, role string, text string"))
    got = {r.conv_id: r for r in chat.digests(made).collect()}
    whole = {r.conv_id: r for r in made.collect()}
    read = {r.conv_id: r.turns for r in made.select("conv_id", chat.read_back(made.formatted).alias("turns")).collect()}
    for c in range(40):
        own = [(r, x) for i, _, r, x in sorted(t for t in turns if t[0] == c)]
        assert [(t.role, t.text) for t in read[c]] == own
        loss = "".join(x for r, x in own if r == "assistant")
        assert got[c].n_turns == len(own) and got[c].loss_chars == len(loss)
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
        text = whole[c].formatted
        assert got[c].formatted_chars == len(text) and "".join(s.text for s in whole[c].segments) == text
        assert text.count("[INST]") == text.count("</s>") == 0
        # One block per run of one role.
        assert text.count(chat.OPEN) == sum(i == 0 or own[i - 1][0] != r for i, (r, _) in enumerate(own))


SITE = """<html><head><title>T</title><style>x</style></head><body class="has-sidebar"><header>Site</header>
<nav><ul><li><a href=/a>A</a></ul></nav><div class="box">Follow us on all channels</div>
<div id=wrap>%s</div><div class="cookie-notice">We use cookies</div><form><input><button>Go</button></form>
<script>var a="<p>no</p>";</script><footer>&copy; site</footer></body></html>"""


def test_pages_lose_their_templates(spark):
    bodies = [f"<h1>Title {i}</h1><p>First   paragraph\n{i} &amp; more<p>Second <b>bold</b> {i}<ul><li>one {i}<li>two</ul>" for i in range(8)]
    rows = [(i, f"https://user@Site.example:80/p/{i}", SITE % b) for i, b in enumerate(bodies)]
    rows.append((99, "https://other.example/", SITE % bodies[0]))  # one page is no template
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in html_text.extract(df).collect()}
    for i in range(8):
        assert got[i] == f"Title {i}\nFirst paragraph {i} & more\nSecond bold {i}\none {i}\ntwo"
    assert got[99].startswith("Follow us on all channels\nTitle 0\n")


def test_copies_of_a_page_make_no_template(spark):
    page = "<body><div class=box><p>Once</p></div><article><p>The text</p><div><p>of the page</p></div></article></body>"
    df = spark.createDataFrame([(i, "http://h.example/", page) for i in range(40)], "page_id long, url string, html string")
    assert {r.text for r in html_text.extract(df).collect()} == {"The text\nof the page"}
    assert html_text.templates(html_text.subtree_rows(df.selectExpr("page_id AS key", "'h' AS host", "html"))).count() == 0


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><header><h1>H</h1></header><p>x</p><aside>s</aside><section class=comments><article class=comment>c</article></section></article>", "H\nx"),
        ("<div id=comments><article class=comment>c</article></div><main><p>m</p></main>", "m"),
        ("<article><p>a<!-- <p>no</p> -->b</p><p>1 < 2 &lt;b&gt; &#233;&nbsp;x</p></article>", "ab\n1 < 2 <b> é x"),
        ("<article><table><tr><td>a<td>b<tr><td>c</table><pre>p\n q</pre></article>", "a\nb\nc\np q"),
        ("<article><p title='a > b'>x</p><p><b>open<br>line<p>next", "x\nopen line\nnext"),
        ("<div class=share><article><p>only here</p></article></div>", "only here"),
        ("<p>no article</p><nav>n</nav>", "no article"),
        ("<script>unclosed", ""),
    ],
)
def test_markup(html, text):
    assert html_text.parse(html).text() == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<article><svg-icon name=x></svg-icon><select-menu></select-menu><title-bar>t</title-bar><p>a</p></article>", "t\na"),
        ("<article><p>a <svg viewBox='0 0 1 1' /> b</p><p>c <math/> d</p></article>", "a b\nc d"),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p><canvas>chart</canvas><object data=f>fallback</object></article>", "so x=2 holds\nchartfallback"),
        ("<article><p>a</p><select><option>o</select><template><p>t</p></template><p>b</p></article>", "a\nb"),
        ("<article><p>a<svg><title>T</title><path d=x></svg>b</p><svg><p>c</p></article>", "ab\nc"),
        ("<article><script>var a='</p>'</script ><p>a</p><iframe>i</iframe\n><noscript>n</noscript><p>b</p></article>", "a\nb"),
    ],
)
def test_raw_and_foreign_elements(html, text):
    assert html_text.parse(html).text() == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<h1>H</h1><div class=text-center><p>a</p></div><p>b</p>", "H\na\nb"),
        ("<div class=entry><p>one</p></div><div class=entry><p>two, longer</p></div>", "one\ntwo, longer"),
        ("<figure class=main-image><figcaption>f</figcaption></figure><div class=main-title>t</div><p>a</p>", "f\nt\na"),
        ("<p>before</p><div class=x role='main'><p>m</p></div>", "m"),
        ("<p>before</p><div data-role=mainly role=mainly><p>m</p></div>", "before\nm"),
    ],
)
def test_class_names_choose_no_content(html, text):
    assert html_text.parse(html).text() == text


@pytest.mark.parametrize(
    "html, text",
    [
        ("<div class='content has-sidebar'><p>a</p></div><div class=no-sidebar><p>b</p></div>", "a\nb"),
        ("<article><div class=entry-header><h1>H</h1></div><h2 class=section-header>S</h2><p>a</p></article>", "H\nS\na"),
        ("<article><p class=related-work>r</p><div class=search-results>s</div><p class=hidden-xs>h</p><p class=footer-note>f</p></article>", "r\ns\nh\nf"),
        ("<main><div class=header><h1>H</h1></div><p class=notice>n</p><div class='x advert'>ad</div></main>", "H\nn"),
        ("<div class='box sidebar'>s</div><div id=comments>c</div><p>a</p>", "a"),
        ("<div data-class=ad data-role=main>d</div><p>a</p>", "d\na"),
        ("<nav>n</nav><div class=alert><p>all there is</p></div>", "all there is"),
        ("<article><div class=comments><p>all there is</p></div></article>", "all there is"),
        ("<div class=alert><nav>n</nav></div>", ""),
    ],
)
def test_names_of_furniture(html, text):
    assert html_text.parse(html).text() == text


def test_given_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {}
    for r in pages.collect():
        article = re.search(r"(?s)<article>(.*?)(</article>|$)", r.html)[1]
        blocks = (" ".join(entities.unescape(re.sub(r"</?b>", "", x)).split()) for x in re.split(r"</?(?:p|h1|br)>", article))
        want[r.page_id] = "\n".join(b for b in blocks if b)
    assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == want


def test_licenses_are_found_with_gaps(spark):
    mit = dict(zip([t for _, t in licenses.TEMPLATES], [n for n, _ in licenses.TEMPLATES]))
    full = next(t for t, n in mit.items() if n == "mit-text")
    words = full.split()
    gapped = " ".join([*words[:12], "extra", "words", *words[12:30], *words[32:]])
    docs = [
        (1, f"Intro. {full.upper()} end"), (2, f"x y {gapped}"), (3, " ".join(words[:10])), (4, "Released under the MIT License."),
        (5, "mit license, MIT-License; the Apache\nLicense; GNU General Public License v3 mit"), (6, "mit licenses; apache2 license"),
    ]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got[1].labels == ["mit-text"] and got[1].score == 1 and got[1].spans[0].first == 1
    assert got[2].labels == ["mit-text"] and licenses.VERIFIED <= got[2].score < 1
    assert got[3].labels == [] and 0 < got[3].score < licenses.VERIFIED
    assert got[4].base == ["mit"] and got[4].labels == ["mit", "mit-notice"]
    assert got[5].base == ["apache", "gpl", "mit"] and (got[5].n_base, got[5].first_word, got[5].last_word) == (4, 0, 8)
    assert got[6].n_base == 0 and got[6].n_words == 4
