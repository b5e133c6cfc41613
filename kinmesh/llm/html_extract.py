"""Main text of web pages by consensus host paths.

Each page's containers are scored by the running text in their blocks; the best give
votes to their generalised tag-class path (tags and classes from the root down, digits
made one).  Votes are summed for each host and path in Spark, and pages are then read
again: the elements on the host's winning path are the article; a page without one
falls back on its own best container, and on its body.

Menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts and
styles are left out wherever they stand, told by tag, role, class or id.  A form, or an
element that only its class or id speaks against, is judged by content too: if what is
kept besides has less than a QUARTER of its running text, it is the page's frame or its
article and stays (reader comments never do).  Character references are decoded, white
space inside a block becomes one space, blocks are trimmed and joined in page order by
one space.  A path is named by a hash, so a page's memory is linear at any depth.

Defined results: null or empty html gives an empty text; a null url is a host of its
own name; broken markup is read as far as it goes (unclosed elements end with their
parents, a cut tag is no text); rows that repeat a page_id are read row by row; an
empty table gives no rows; further columns are carried along by `extract`.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices, small, stage, tidy

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|textarea|iframe|svg|select|option)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)"
    r"|<[a-z][^<>]*+\Z",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body main article section div td center".split())
#: Start tags that end an open element of the second set within the nearest of the third.
CLOSES = {t: (frozenset({"p"}), frozenset()) for t in "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()}
CLOSES |= {
    "li": (frozenset({"li", "p"}), frozenset({"ul", "ol", "menu"})),
    "dt": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd", "p"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th", "p"}), frozenset({"table"})),
    "td": (frozenset({"td", "th", "p"}), frozenset({"table", "tr"})),
    "th": (frozenset({"td", "th", "p"}), frozenset({"table", "tr"})),
}
SCOPE = frozenset({"html", "body", "table", "td", "th", "article", "section", "div", "main", "li", "blockquote"})
OUT_TAGS = frozenset("head title nav header footer aside menu button dialog object canvas audio video label fieldset".split())
OUT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
OUT_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead footer sidebar aside rail ad ads advert adverts advertisement adsense sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus respond reply replies share sharing social "
    "related recommended recommendations widget widgets pagination pager toolbar search skip print legal copyright".split()
)
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
MAIN_WORDS = COMMENT_WORDS | frozenset("ad ads advert advertisement sponsored promo related".split())
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
#: Words beside which another one tells how a page is laid out, not what an element is; the second set as a name's last word.
MODIFIERS, FRAME = frozenset({"has", "with", "without", "no"}), frozenset({"page", "site", "layout", "template"})
SHARE, QUARTER = 0.3, 0.25
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
KEPT, JUDGED, OUT = 0, 1, 2


def _standing(tag: str, found: dict) -> int:
    """KEPT, OUT, or JUDGED: left out unless its content speaks for it."""
    if tag in OUT_TAGS or "hidden" in found or found.get("aria-hidden", "").lower() == "true":
        return OUT
    if found.get("role", "").lower() in OUT_ROLES or "display:none" in found.get("style", "").replace(" ", "").lower():
        return OUT
    if tag in ("html", "body"):
        return KEPT
    words = MAIN_WORDS if tag in ("article", "main") else OUT_WORDS
    out = JUDGED if tag == "form" else KEPT
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        parts = [w.lower() for w in WORDS.findall(name)]
        if not parts or MODIFIERS.intersection(parts) or parts[-1] in FRAME:
            continue
        if COMMENT_WORDS.intersection(parts):
            return OUT
        if words.intersection(parts):
            out = JUDGED
    return out


def _worth(text: str, linked: int) -> float:
    """Running text, the less the more of it is links."""
    return (len(text) - linked) * (1 - linked / len(text))


class Page:
    """Elements in order (parent, tag, path, nearest container, nearest article, judged one that
    leaves it out) and blocks of text (element, text, of it in links)."""

    def __init__(self, source: str | None):
        self.parent, self.tag, self.path = [-1], [""], [0]
        self.box, self.main, self.judged = [0], [0], [0]
        self.blocks: list[tuple[int, str, int]] = []
        self._doubtful: list[tuple[int, str, int]] = []
        self._all: list[tuple[int, str, int]] = []
        self._open, self._text, self._linked, self._links = [0], [], 0, 0
        self._count: dict[str, int] = {}
        at, source = 0, source or ""
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self._say(source[at : m.start()])
            at = m.end()
            if m.group(3):
                tag = m.group(3).lower()
                if m.group(2):
                    self._close(tag)
                else:
                    self._start(tag, m.group(4))
        if at < len(source):
            self._say(source[at:])
        self._flush()
        self._judge()

    def _judge(self):
        """Keep the judged elements whose content is the page's."""
        if not self._doubtful:
            return
        order = {id(b): i for i, b in enumerate(self._all)}
        while True:
            held: dict[int, float] = {}
            for e, text, linked in self._doubtful:
                j = self.judged[e]
                held[j] = held.get(j, 0.0) + _worth(text, linked)
            best = max(held, key=lambda j: (held[j], -j), default=0)
            if not best or sum(_worth(t, n) for _, t, n in self.blocks) >= QUARTER * held[best] or held[best] <= 0:
                return
            kept, e = set(), best  # with what it stands in; the next best has no more text, so two rounds end this
            while e > 0:
                kept.add(e)
                e = self.judged[self.parent[e]]
            self.judged = [0 if j in kept else j for j in self.judged]
            freed = [b for b in self._doubtful if not self.judged[b[0]]]
            self._doubtful = [b for b in self._doubtful if self.judged[b[0]]]
            self.blocks = sorted(self.blocks + freed, key=lambda b: order[id(b)])

    def _say(self, text: str):
        if "&" in text:
            text = html.unescape(text)
        self._text.append(text)
        if self._links:
            self._linked += len(text)

    def _flush(self):
        if self._text:
            text = " ".join("".join(self._text).split())
            e = self._open[-1]
            if text and self.judged[e] >= 0:
                block = (e, text, min(self._linked, len(text)))
                self._all.append(block)
                (self._doubtful if self.judged[e] else self.blocks).append(block)
            self._text.clear()
        self._linked = 0

    def _start(self, tag: str, attributes: str):
        if tag == "a":
            self._links += 1
        if tag in INLINE:  # inline elements part no blocks and are no containers
            return
        self._flush()
        if tag in VOID:
            return
        if tag in CLOSES:
            ends, within = CLOSES[tag]
            left = sum(self._count.get(t, 0) for t in ends)
            for i in range(len(self._open) - 1, 0, -1):
                name = self.tag[self._open[i]]
                if not left or name not in ends and (name in within or name in SCOPE):
                    break
                if name in ends:
                    self._end(i)
                    left = sum(self._count.get(t, 0) for t in ends)
        found = {}
        for m in ATTRIBUTE.finditer(attributes) if attributes else ():
            found.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
        up, e = self._open[-1], len(self.tag)
        names = sorted(set(re.sub(r"\d+", "0", found.get("class", "")).split()))
        self.parent.append(up)
        self.tag.append(tag)
        self.path.append(xxhash.xxh3_64_intdigest(f"{self.path[up]}/{'.'.join([tag, *names])}") - (1 << 63))
        self.box.append(e if tag in CONTAINERS else self.box[up])
        self.main.append(e if tag in ("article", "main") else self.main[up])
        standing = _standing(tag, found)
        self.judged.append(-1 if standing == OUT or self.judged[up] < 0 else e if standing == JUDGED else self.judged[up])
        self._open.append(e)
        self._count[tag] = self._count.get(tag, 0) + 1

    def _end(self, i: int):
        """Close the i-th open element and all in it."""
        for e in self._open[i:]:
            self._count[self.tag[e]] -= 1
        del self._open[i:]

    def _close(self, tag: str):
        if tag == "a":
            self._links = max(0, self._links - 1)
        if tag in INLINE:
            return
        self._flush()
        for i in range(len(self._open) - 1, 0, -1) if self._count.get(tag) else ():
            if self.tag[self._open[i]] == tag:
                self._end(i)
                break
            if self.tag[self._open[i]] in ("article", "main", "body", "table") and tag not in ("article", "main", "body", "html", "table", "div", "section"):
                break
        self._links = 0

    def scores(self) -> dict[int, float]:
        """Containers by the running text in them: all of it for the nearest, half for the next one up."""
        out: dict[int, float] = {}
        for element, text, linked in self.blocks:
            worth = _worth(text, linked)
            if worth <= 0:
                continue
            share, e = 1.0, self.box[element]
            while e > 0 and share > 0.2:
                out[e] = out.get(e, 0.0) + share * worth
                share /= 2
                e = self.box[self.parent[e]]
        return out

    def best(self) -> list[tuple[int, float]]:
        """Containers with their share of the best one's score, the best first."""
        found: dict[int, float] = {}
        for e, s in self.scores().items():
            whole = self.main[e] or e  # the article around it
            found[whole] = max(found.get(whole, 0.0), s)
        top = max(found.values(), default=0.0)
        return sorted(((e, s / top) for e, s in found.items()), key=lambda x: (-x[1], x[0]))

    def text(self, roots: set[int]) -> str:
        """Blocks inside the elements, in page order."""
        inside = [False] * len(self.tag)
        for e in range(1, len(self.tag)):
            inside[e] = e in roots or inside[self.parent[e]]
        return " ".join(t for e, t, _ in self.blocks if inside[e])

    def article(self, winners: list[int]) -> str:
        for path in winners:
            roots = {e for e, p in enumerate(self.path) if p == path and not self.judged[e]}
            if roots and (text := self.text(roots)):
                return text
        best = self.best()
        if best:
            return self.text({best[0][0]})
        return " ".join(t for _, t, _ in self.blocks)


def _votes(batches):
    for b in slices(batches):
        votes: dict[tuple[str, int], float] = {}
        for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            page = Page(source)
            for e, share in page.best()[:1]:
                votes[host, page.path[e]] = votes.get((host, page.path[e]), 0.0) + share
        keys = list(votes)
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in keys], pa.string()), pa.array([p for _, p in keys], pa.int64()), pa.array(list(votes.values()), pa.float64())], ["host", "path", "votes"])


def winning_paths(hosted: DataFrame) -> DataFrame:
    """(host, winners): paths with at least SHARE of the first one's votes, most votes first."""
    votes = hosted.select("__host", "html").mapInArrow(tidy(_votes), "host string, path long, votes double")
    votes = votes.groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"))
    most = votes.groupBy("host").agg(F.max("votes").alias("most"))
    # at most 1 / SHARE paths of a host pass, by the sum of its votes; near ties may add a few
    near = votes.join(most, "host").filter(F.col("votes") >= SHARE * F.col("most"))
    ranked = F.transform(F.array_sort(F.collect_list(F.struct((-F.col("votes")).alias("v"), "path"))), lambda x: x["path"])
    return near.groupBy(F.col("host").alias("__host")).agg(ranked.alias("__winners"))


def extract(pages: DataFrame) -> DataFrame:
    """pages, html replaced by text, and n_chars."""
    hosted = pages.withColumn("__host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST, 1)))
    winners = small(stage(winning_paths(hosted), "winners"))
    kept = [c for c in pages.columns if c not in ("html", "text", "n_chars")]

    def run(batches):
        for b in slices(batches):
            texts = [Page(h).article(w or []) if h else "" for h, w in zip(b.column("html").to_pylist(), b.column("__winners").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in kept] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], [*kept, "text", "n_chars"])

    schema = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in kept) + "text string, n_chars long"
    return hosted.join(winners, "__host", "left").select(*kept, "html", "__winners").mapInArrow(tidy(run), schema)


def query(pages: DataFrame) -> DataFrame:
    return extract(pages.select("page_id", "url", "html"))
