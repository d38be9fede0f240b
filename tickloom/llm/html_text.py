"""Main text of web pages by removal of site templates.

Every page is cut into elements. The subtrees outside the article are hashed, and Spark counts, per
host, on how many pages with different content each hash stands; a subtree on ``MIN_PAGES`` or more, and
on at least ``SHARE`` of the host's pages, belongs to the site's template and is deleted wherever it
occurs on that host. Copies of one page do not make its text a template, since they have one content.
Paragraphs inside an article are never counted. What the markup itself names as furniture (``nav``,
``aside``, ``class="cookie-notice"``) goes in any case, also on hosts with too few pages to count. A class,
id or role counts as a whole name, inside an article only those of comments, adverts and cookie notices
do, and none of the others counts, nor does a ``form``, for an element that holds most of the page's text.

The article is the ``article`` elements if they hold the larger part of the prose around them, else the
``main`` elements (or role=main) under the same condition, else the page.

Pages are parsed once, where they lie. What is left of a page, its texts with the hashes of the subtrees
around them, is a stored table; only hashes, and where there are many deletions those texts, are shuffled,
the html never is. A subtree's hash is made of its own markup and its children's hashes, so the work
is linear in the page.

Defined cases: null or empty html gives an empty text; a null or unreadable url has no host, and its
page is never counted nor trimmed by counts; rows equal in all columns get equal results; broken markup
is read as browsers do for the usual faults (open paragraphs, list items and inline elements, a
missing end, quotes in attributes); a page without article and main elements keeps all that is neither
furniture nor template, whatever its classes are called; an empty table gives an empty table.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import small_batches, stored

MIN_PAGES = 5  # of a host, that a template stands on at least
SHARE = 0.05  # of the host's pages, likewise
PROSE = 80  # characters, white space not counted, from which on a block outside the article is prose

# Element names by their part in a page.
RAW = "script style noscript textarea title iframe"  # whatever stands in them is no markup
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
FURNITURE = set("nav footer aside form head button dialog menu input label legend fieldset select template".split())
OUTER_FURNITURE = {"header"}  # only outside of an article
CONTAINERS = set("div section ul ol dl table figure details center".split())
NEVER = set("html body article main".split())
# Elements that can be part of a template as a whole; inline elements, list items and cells are too small to tell.
COUNTED = CONTAINERS | FURNITURE | OUTER_FURNITURE | {"p"}
# An opening tag of the first kind ends an open element of the second.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}}

# Whole names in class, id and role that name page furniture outside the content.
FURNITURE_NAMES = set(
    "nav navbar navigation menu menus sidebar sidebars footer header masthead topbar breadcrumb breadcrumbs pagination pager "
    "cookie cookies consent gdpr notice notices alert banner banners popup modal overlay ad ads advert adverts advertisement "
    "advertising sponsor sponsored promo promotion comment comments disqus respond reply replies share sharing social related "
    "recommended teaser teasers newsletter subscribe subscription signup login search searchform widget widgets contentinfo "
    "complementary toolbar skip hidden".split()
)
# Those that are furniture inside the content too.
FOREIGN_NAMES = set(
    "comment comments comment-list comments-area disqus disqus_thread respond ad ads advert adverts advertisement advertising "
    "sponsored cookie-notice cookie-banner cookie-consent cookie-bar gdpr".split()
)

# Whole names of containers whose header is the article's own.
CONTENT_NAMES = set("post entry story hentry article blog-post".split())
# Names of reader comments and their parts.
COMMENTS = re.compile(
    r"(?:user-?|reader-?|wp-?)?comments?[-_]?(?:list|section|area|thread|threads|form|wrapper|container|box|block|holder|body|item|author|content|text|feed|reply|respond)?"
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW.split())})(?=[\s/>])(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<[!?/][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
MAIN = re.compile(r"(?<![\w-])role\s*=\s*[\"']?\s*main(?=[\s\"'/]|\Z)", re.I)


class Page:
    """Elements of one page in document order, each with its parent, span and names, and the texts."""

    def __init__(self, html: str):
        self.html = html
        self.tags, self.parents, self.starts, self.ends, self.names = ["#page"], [-1], [0], [len(html)], [frozenset()]
        self.kinds = [""]  # article, main or other; an element whose role is main counts as one
        self.items: list[tuple[int, str | None]] = []  # (element, text), or (element, None) at a block's edge
        # Depths of the open elements by tag, and of the open blocks.
        self.open: dict[str, list[int]] = {}
        self.open_blocks: list[int] = []
        stack, at = [0], 0
        for m in TOKEN.finditer(html):
            if m.start() > at:
                self.items.append((stack[-1], html[at : m.start()]))
            at = m.end()
            tag = m["tag"]
            if tag is None:
                continue
            tag = tag.lower()
            if m["close"]:
                self._close(stack, tag, at)
            else:
                self._open(stack, tag, m["attrs"], m.start(), at)
        if at < len(html):
            self.items.append((stack[-1], html[at:]))

    def _open(self, stack: list[int], tag: str, attrs: str, start: int, end: int) -> None:
        if tag == "br":
            self.items.append((stack[-1], " "))
            return
        if tag in BLOCKS:
            if tag not in ("html", "body", "head"):
                self._end_open(stack, {"p"}, set("td th button div li article section".split()) if tag != "p" else {"td", "th"}, start)
            if tag in ENDS:
                self._end_open(stack, ENDS[tag], SCOPES.get(tag, set()), start)
            if tag == "body":
                self._end_open(stack, {"head"}, set(), start)
        if tag in BLOCKS:
            self.items.append((stack[-1], None))
        if tag in VOID or attrs.endswith("/") and tag not in BLOCKS:
            return
        found = NAMES.findall(attrs) if attrs else ()
        names = frozenset(w for f in found for w in "".join(f).lower().split())
        self.open.setdefault(tag, []).append(len(stack))
        if tag in BLOCKS:
            self.open_blocks.append(len(stack))
        stack.append(len(self.tags))
        self.tags.append(tag)
        self.kinds.append(tag if tag == "article" else "main" if tag == "main" or attrs and MAIN.search(attrs) else "")
        self.parents.append(stack[-2])
        self.starts.append(start)
        self.ends.append(len(self.html))
        self.names.append(names)

    def _deepest(self, tags: Iterable[str]) -> int:
        """Depth of the nearest open element of ``tags``; 0 if there is none."""
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=0)

    def _end_open(self, stack: list[int], tags: set[str], within: set[str], at: int) -> None:
        """End the nearest open element of ``tags``, unless one of ``within`` stands in between."""
        depth = self._deepest(tags)
        if depth and depth >= max(self._deepest(within), self._deepest(NEVER)):
            self._pop(stack, depth, at)

    def _close(self, stack: list[int], tag: str, at: int) -> None:
        depth = self._deepest((tag,))
        if depth and (tag in BLOCKS or not self.open_blocks or self.open_blocks[-1] < depth):
            self._pop(stack, depth, at)

    def _pop(self, stack: list[int], depth: int, at: int) -> None:
        while len(stack) > depth:
            e = stack.pop()
            self.open[self.tags[e]].pop()
            self.ends[e] = at
            if self.tags[e] in BLOCKS:
                self.open_blocks.pop()
                self.items.append((stack[-1], None))

    def read(self) -> None:
        """Mark, per element, furniture (``dropped``) and the inside of the content (``inside``)."""
        n = len(self.tags)
        self.sizes = [0 if piece is None else len("".join(piece.split())) for _, piece in self.items]
        by_tag, by_name, foreign, in_article, holds = ([False] * n for _ in range(5))
        own_header = [False] * n
        for e in range(1, n):
            tag, up, names = self.tags[e], self.parents[e], self.names[e]
            in_article[e] = in_article[up] or self.kinds[e] != ""
            own_header[e] = own_header[up] or in_article[e] or bool(names & CONTENT_NAMES)
            if tag not in ("html", "body"):
                by_tag[e] = tag in FURNITURE or tag in OUTER_FURNITURE and not own_header[up]
                foreign[e] = bool(names & FOREIGN_NAMES) or any(COMMENTS.fullmatch(x) for x in names)
                by_name[e] = not foreign[e] and not in_article[e] and bool(names & FURNITURE_NAMES)
        self._drop([False] * n)
        self.weights = self._lengths(self._under([f or t and self.tags[e] != "form" for e, (f, t) in enumerate(zip(foreign, by_tag, strict=True))]))
        for e in range(1, n):
            if 2 * self.weights[e] > self.weights[0]:
                by_name[e] = False
                if self.tags[e] == "form":
                    by_tag[e] = False
        own = [t or m or f for t, m, f in zip(by_tag, by_name, foreign, strict=True)]
        self._drop(own)
        whole = [e for e in range(1, n) if self.kinds[e] and not in_article[self.parents[e]]]
        if whole and all(self.dropped[e] for e in whole):
            # Every article stands in something named like furniture: the names mislead here.
            for e in whole:
                while e > 0:
                    holds[e], e = True, self.parents[e]
            self._drop([f and not h for f, h in zip(own, holds, strict=True)])
        if (any(by_name) or any(foreign)) and not self._says_anything():
            # All of the content has such names.
            self._drop([f and not h for f, h in zip(by_tag, holds, strict=True)])

    def _says_anything(self) -> bool:
        return any(n and not self.dropped[e] and (not self.roots or self.inside[e]) for (e, _), n in zip(self.items, self.sizes, strict=True))

    def _lengths(self, gone: list[bool], least: int = 0) -> list[int]:
        """Characters of text per element, all below included; with ``least``, of blocks that have as many."""
        total, block = [0] * len(self.tags), []

        def ended() -> None:
            if sum(k for _, k in block) >= least:
                for e, k in block:
                    total[e] += k
            block.clear()

        for (e, piece), size in zip(self.items, self.sizes, strict=True):
            if piece is None:
                if block:
                    ended()
            elif size and not gone[e]:
                block.append((e, size))
        ended()
        for e in range(len(total) - 1, 0, -1):
            total[self.parents[e]] += total[e]
        return total

    def _drop(self, marked: list[bool]) -> None:
        n = len(self.tags)
        self.dropped, self.trees = self._under(marked), None
        self.roots = self._roots()
        self.inside = [False] * n
        for e in range(n):
            self.inside[e] = e in self.roots or e > 0 and self.inside[self.parents[e]]

    def _under(self, marked: list[bool]) -> list[bool]:
        """The marked elements and all below them."""
        out = list(marked)
        for e in range(1, len(out)):
            out[e] = out[e] or out[self.parents[e]]
        return out

    def _roots(self) -> set[int]:
        """The articles or the main elements, if they hold the larger part of the prose around them.

        Otherwise the page is content as a whole: a short article beside a long text, or a teaser inside
        the text, is not all that the page has to say.
        """
        live = [e for e in range(1, len(self.tags)) if not self.dropped[e]]
        named = {kind: [e for e in live if self.kinds[e] == kind] for kind in ("article", "main")}
        if not any(named.values()):
            return set()
        texts, prose = self._lengths(self.dropped), self._lengths(self.dropped, PROSE)
        scopes = {"article": named["main"] or [0], "main": [0]}
        for kind, found in named.items():
            inside = self._outermost(found)
            held, own = sum(texts[e] for e in inside), sum(prose[e] for e in inside)
            around = sum(prose[e] for e in self._outermost([*scopes[kind], *found]))
            if inside and (held >= around - own or not held and not around):
                return set(found)
        return set()

    def _outermost(self, elements: list[int]) -> list[int]:
        """Those that are in none of the others."""
        chosen, below = set(elements), [False] * len(self.tags)
        out = []
        for e in range(len(self.tags)):
            above = e > 0 and below[self.parents[e]]
            if e in chosen and not above:
                out.append(e)
            below[e] = above or e in chosen
        return out

    def content_hash(self) -> int:
        """Identity of what the page says: its articles, or the whole page if it names none."""
        parts = [self.html[self.starts[e] : self.ends[e]] for e in sorted(self.roots)] or [self.html]
        return _hash("\n".join(parts))

    def subtrees(self) -> list[tuple[int, int, bool]]:
        """(element, hash, open): subtrees that may be part of a template; open if nothing else drops them."""
        if self.trees is not None:
            return self.trees
        holds_root = [False] * len(self.tags)
        for r in self.roots:
            while r >= 0 and not holds_root[r]:
                holds_root[r], r = True, self.parents[r]
        hashes = self._hashes()
        found = []
        for e in range(1, len(self.tags)):
            tag = self.tags[e]
            if tag not in COUNTED or holds_root[e]:
                continue
            if not self.inside[e] or tag in CONTAINERS:
                found.append((e, hashes[e], not self.dropped[e]))
        self.trees = found
        return found

    def _hashes(self) -> list[int]:
        """Hash of every element from its own markup and its children's hashes."""
        children: list[list[int]] = [[] for _ in self.tags]
        for e in range(1, len(self.tags)):
            children[self.parents[e]].append(e)
        out = [0] * len(self.tags)
        for e in range(len(self.tags) - 1, 0, -1):
            at, parts = self.starts[e], []
            for c in children[e]:
                parts += [self.html[at : self.starts[c]], f"\0{out[c]}\0"]
                at = self.ends[c]
            out[e] = _hash("".join([*parts, self.html[at : self.ends[e]]]))
        return out

    def skeleton(self) -> tuple[list[tuple[int, int]], list]:
        """The open subtrees, and the texts that are not dropped, each with the subtree around it.

        A subtree is (hash, number of the one around it or -1), a text (text, number of its subtree or
        -1); a block's edge is null.
        """
        counted = {e: h for e, h, is_open in self.subtrees() if is_open}
        trees: list[tuple[int, int]] = []
        around = [-1] * len(self.tags)
        for e in range(1, len(self.tags)):
            around[e] = around[self.parents[e]]
            if e in counted:
                trees.append((counted[e], around[e]))
                around[e] = len(trees) - 1
        kept: list = []
        for e, piece in self.items:
            if piece is None:
                if kept and kept[-1] is not None:
                    kept.append(None)
            elif not self.dropped[e] and (not self.roots or self.inside[e]):
                kept.append((entities.unescape(piece) if "&" in piece else piece, around[e]))
        return trees, kept

    def text(self, template: frozenset[int] = frozenset()) -> str:
        return joined_text(*self.skeleton(), template)


def joined_text(trees: list, kept: list, template: frozenset[int] | set[int]) -> str:
    """Blocks of the texts that stand in no subtree of the template, white space made single."""
    gone: list[bool] = []
    for h, up in trees:
        gone.append(h in template or up >= 0 and gone[up])
    gone.append(False)  # of texts without a subtree, whose number is -1
    blocks, parts = [], []
    for item in [*kept, None]:
        if item is None:
            blocks.append(" ".join("".join(parts).split()))
            parts = []
        elif not gone[item[1]]:
            parts.append(item[0])
    return "\n".join(b for b in blocks if b)


def _hash(raw: str) -> int:
    """Signed 64-bit hash of markup, whatever its white space."""
    value = xxhash.xxh64_intdigest(" ".join(raw.split()).encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def parse(html: str | None) -> Page:
    page = Page(html or "")
    page.read()
    return page


def host_of(url: Column) -> Column:
    """Host of a url in lower case, without user and port; null if there is none."""
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def read_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with content, hashes, open and kept in place of the html: what is left of each page.

    ``hashes`` and ``open`` are the subtrees that may be part of a template; ``kept`` holds the skeleton as JSON.
    """

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parsed = [parse(html) for html in batch.pop("html")]
            batch["content"] = [page.content_hash() for page in parsed]
            found = [sorted({(h, o) for _, h, o in page.subtrees()}) for page in parsed]
            batch["hashes"], batch["open"] = [[h for h, _ in f] for f in found], [[o for _, o in f] for f in found]
            batch["kept"] = [json.dumps(page.skeleton(), ensure_ascii=True) for page in parsed]
            yield batch

    own = ", ".join(f"{n} {t}" for n, t in pages.drop("html").dtypes)
    return pages.mapInPandas(rows, f"{own}, content long, hashes array<long>, open array<boolean>, kept string")


def _subtrees(read: DataFrame) -> DataFrame:
    each = F.explode_outer(F.arrays_zip("hashes", "open")).alias("s")
    found = read.where("host IS NOT NULL").select("key", "host", "content", each)
    return found.select("key", "host", "content", F.col("s.hashes").alias("hash"), "s.open")


def subtree_rows(pages: DataFrame) -> DataFrame:
    """key, host, content, hash, open: one row per subtree that may be part of a template, of key, host, html."""
    return _subtrees(read_pages(pages))


def templates(found: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """host, hash: subtrees on enough pages of different content of one host; ``found``: host, content, hash."""
    sizes = found.select("host", "content").distinct().groupBy("host").agg(F.count("*").alias("n_all"))
    counted = found.where("hash IS NOT NULL").select("host", "hash", "content").distinct().groupBy("host", "hash").agg(F.count("*").alias("n_pages"))
    least = F.greatest(F.lit(min_pages), F.ceil(F.col("n_all") * share))
    return counted.where(F.col("n_pages") >= min_pages).join(sizes, "host").where(F.col("n_pages") >= least).select("host", "hash")


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, share: float = SHARE) -> DataFrame:
    """page_id, url, text, n_template: the main text and how many template subtrees were deleted for it."""
    small_batches(pages.sparkSession)
    keyed = pages.select(
        "page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("key"), host_of(F.col("url")).alias("host")
    )
    read = stored(read_pages(keyed), "pages")
    found = _subtrees(read)
    least = stored(templates(found, min_pages, share), "templates")
    deletions = stored(
        found.where("open").join(least, ["host", "hash"]).groupBy("key").agg(F.collect_set("hash").alias("gone")), "deletions"
    )
    joined = read.select("page_id", "url", "key", "kept").join(deletions, "key", "left")

    @F.pandas_udf("string")
    def text_of(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for kept, gone in batches:
            out = []
            for text, drop in zip(kept, gone, strict=True):
                out.append(joined_text(*json.loads(text), set() if drop is None else {int(h) for h in drop}))
            yield pd.Series(out, dtype=object)

    return joined.select(
        "page_id", "url", text_of("kept", "gone").alias("text"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).alias("n_template")
    )
