"""Operator 10: main text of web pages by equivalence-class templates.

Every page is a tree of elements; an element's role is its tag and class names
below the role of its parent. Tokens are roles and text blocks (a text beneath
a role). Per host, over all its different pages, an ordinary shuffle aggregate
gives each token its vector of occurrences (as a fingerprint), the number of its
pages and the sizes of its text. Tokens of equal vectors are an equivalence
class. Roles found at most once a page, on a sixteenth of the pages or more, are
the skeleton and nest by their paths. Text blocks found on more than half of
the pages (two at least) are template if their class holds a role, too, or
covers every page. What remains lies in the skeleton's slots.

The article is chosen by what the slots hold. From the root the walk goes to the
slot with half or more of the text that is neither template nor link, as long
as there is one; then up again while nothing but such text is gained: menus
bring links, notices template. If it stops below an element that holds
headlines, too, these belong to the article. Inside, blocks wholly of template
and containers mostly of links or template go.

Fixed names of elements and classes (``MARKS``, ``ARTICLE``, ``NOT_ARTICLE``) only
break ties, where the template has no say: the walk does not go up from an
article element, nor for text of a marked one, and marked elements below the
chosen one go, unless nothing else is left. On a host's only page, which has no
other to be compared with, marked slots come after all others.

Pages are scanned twice, first for the tokens and then with the template of
their host, whose size is bounded by that of some sixteen pages; no page meets
all others of its host in a task.

Defined cases: null html is an empty page with empty text; a null or odd url
counts as a host of its own name; equal pages of a host count once, so a host's
only page has a skeleton, but no template text; repeated rows give repeated
results; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import json
import re
from collections import Counter
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

LAYOUTS = 16           # roles on a smaller part of a host's pages are no template

RESULT = "page_id string, url string, text string, n_chars long"
TOKENS = ("host string, page long, tokens array<struct<key:bigint,parent:bigint,tag:string,n:bigint,chars:bigint,"
          "link:bigint,marked:bigint,up:bigint>>")

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "noscript", "template", "iframe", "xmp"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSED_BY_SAME = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                  "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
SCOPE = {"ul", "ol", "table", "article", "section", "div", "main", "body", "nav", "aside", "footer", "header", "select", "dl"}
PAST_P = SCOPE | {"h1", "h2", "h3", "h4", "h5", "h6", "pre", "blockquote", "form", "hr", "figure"}
ARTICLE = {"article", "main"}
NOT_ARTICLE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "svg", "object"}
MARKS = set("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies
consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login comment
comments commentlist disqus respond replies sidebar aside menu menus nav navbar navigation breadcrumb breadcrumbs footer
header masthead topbar toolbar share sharing social related widget widgets search pagination contentinfo complementary
""".split())

_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*+)>""", re.S)
_ATTR = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
ROOT = 0
OPEN, CLOSE, PART, SPACE, TEXT = range(5)


def _key(parent: int, name: str) -> int:
    return xxhash.xxh64_intdigest(f"{parent}\0{name}".encode("utf-8", "surrogatepass")) >> 1 or 1


def mark(tag: str, attrs: str) -> int:
    """2: by tag or names none of the article; 1: a header, which may be one's own."""
    if tag in NOT_ARTICLE:
        return 2
    if tag not in ("html", "body", "main") and any(
            n.lower() in MARKS for m in _ATTR.finditer(attrs) for n in _NAME.findall(m[2] or m[3] or m[4] or "")):
        return 2
    return 1 if tag == "header" else 0


def events(page: str) -> list[tuple]:
    """A page as (OPEN, role, parent, tag, mark), (CLOSE, tag), (PART,), (SPACE,) and
    (TEXT, text, key) in order; every element is closed. What lies in a head
    is not shown and is no text."""
    out, stack, at, n = [], [], 0, len(page)     # stack: (tag, role)
    unseen = 0                                   # depth at which a head was opened

    def text(a, b):
        if b > a and not unseen:
            t = _html.unescape(page[a:b])
            out.append((TEXT, t, _key(stack[-1][1] if stack else ROOT, " " + " ".join(t.split()))))

    def close(depth):
        nonlocal unseen
        while len(stack) > depth:
            out.append((CLOSE, stack.pop()[0]))
        unseen = unseen if len(stack) >= unseen else 0

    while at < n:
        m = _TAG.search(page, at)
        if not m:
            break
        text(at, m.start())
        at = m.end()
        if not m[2]:
            continue
        tag, attrs = m[2].lower(), m[3]
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if depth >= 0:
                close(depth)
            elif tag not in INLINE:
                out.append((PART,))
            continue
        if unseen and tag == "body":
            close(unseen - 1)
        ends = CLOSED_BY_SAME.get(tag, set()) | ({"p"} if tag in PAST_P else set())
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    close(i)
                    break
                if stack[i][0] in SCOPE:
                    break
        if tag in VOID or tag in RAW or attrs.rstrip().endswith("/"):
            out.append((SPACE,) if tag == "br" else (PART,)) if tag not in INLINE else None
            if tag in RAW and not attrs.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                at = end.end() if end else n
            continue
        parent = stack[-1][1] if stack else ROOT
        names = sorted({w for a in _ATTR.finditer(attrs) if a[1].lower() == "class"
                        for w in (a[2] or a[3] or a[4] or "").split() if not any(c.isdigit() for c in w)})
        role = _key(parent, " ".join([f"<{tag}", *names]))
        stack.append((tag, role))
        out.append((OPEN, role, parent, tag, mark(tag, attrs)))
        if tag == "head" and not unseen:
            unseen = len(stack)
    if at < n:
        text(at, n)
    close(0)
    return out


def token_counts(page: str) -> list[tuple]:
    """(key, parent, tag or None, occurrences, chars, link, marked, up) of every role
    and text block. chars: of the text beneath; link: of it within links; marked:
    within marked elements below; up: what of it counts as marked for the parent."""
    found: dict[int, list] = {}

    def add(key, parent, tag, chars, link, marked, up):
        row = found.setdefault(key, [key, parent, tag, 0, 0, 0, 0, 0])
        for i, v in enumerate((1, chars, link, marked, up), 3):
            row[i] += v

    stack = [[ROOT, ROOT, "", 0, 0, 0, 0]]       # role, parent, tag, mark, chars, link, marked
    links = 0
    for e in events(page):
        if e[0] == OPEN:
            stack.append([*e[1:], 0, 0, 0])
            links += e[3] == "a"
        elif e[0] == CLOSE:
            role, parent, tag, level, chars, link, marked = stack.pop()
            links -= tag == "a"
            up = chars if level else marked
            add(role, parent, tag, chars, link, marked, up)
            for i, v in enumerate((chars, link, up), 4):
                stack[-1][i] += v
        elif e[0] == TEXT:
            size = len(e[1].strip())
            if size:
                link = size if links else 0
                add(e[2], stack[-1][0], None, size, link, 0, 0)
                stack[-1][4] += size
                stack[-1][5] += link
    add(ROOT, ROOT, "", *stack[0][4:], 0)
    return [tuple(r) for r in found.values()]


class Template:
    """Skeleton, template texts and slots of a host, from the counts of its
    tokens: (key, parent, tag, pages, most, vector, chars, link, marked, up)."""

    def __init__(self, pages: int, rows: list):
        classes = Counter()
        for r in rows:
            classes[r[5]] += r[2] is not None
        self.texts = {r[0] for r in rows if r[2] is None and r[3] >= 2 and 2 * r[3] > pages
                      and (classes[r[5]] or r[3] == pages)}
        self.roles = {r[0]: r for r in rows if r[2] is not None}
        root = self.roles.get(ROOT)
        self.alone = pages == 1 and root is not None and root[6] > root[8]
        self.fixed = Counter()
        for r in rows:
            if r[0] in self.texts:
                at = r[1]
                while True:
                    self.fixed[at] += r[6] - r[7]
                    if at == ROOT or at not in self.roles:
                        break
                    at = self.roles[at][1]
        self.skeleton = {k for k, r in self.roles.items() if r[4] == 1 and r[2] not in INLINE}
        self.above = {}                          # the skeleton's own tree
        for k in self.skeleton - {ROOT}:
            at = self.roles[k][1]
            while at != ROOT and at not in self.skeleton and at in self.roles:
                at = self.roles[at][1]
            self.above[k] = at if at in self.skeleton else ROOT
        self.below: dict[int, list] = {}
        for k, p in self.above.items():
            self.below.setdefault(p, []).append(k)
        self.junk = {k for k in self.skeleton if self.roles[k][2] in SCOPE and self.roles[k][6]
                     and 2 * (self.roles[k][7] + self.fixed[k]) >= self.roles[k][6]}

    def free(self, k: int) -> int:
        """Size of the text that is neither template nor link nor, where there is
        no other page to tell and some text is unmarked, marked."""
        r = self.roles.get(k)
        if not r:
            return 0
        marked = (r[8] if k == ROOT else r[9]) if self.alone else 0
        return max(r[6] - marked - r[7] - self.fixed[k], 0)

    def _dirt(self, k: int, as_part: bool) -> int:
        """What beneath a role is link, template or marked, seen from above or inside."""
        r = self.roles[k]
        return r[7] + self.fixed[k] + (r[9] if as_part else r[8])

    def region(self, present: set) -> tuple[int, set]:
        """The article's role among those of a page, and roles of headlines beside it."""
        chain = [ROOT]
        if ROOT not in self.roles:
            return ROOT, set()
        while True:
            slots = [k for k in self.below.get(chain[-1], ()) if k in present]
            best = max(slots, key=lambda k: (self.free(k), k), default=None)
            if best is None or not self.free(best) or 2 * self.free(best) < self.free(chain[-1]):
                break
            chain.append(best)
        while len(chain) > 1 and self.roles[chain[-1]][2] not in ARTICLE \
                and self._dirt(chain[-2], False) <= self._dirt(chain[-1], True):
            chain.pop()
        heads = set()
        if len(chain) > 1 and self.roles[chain[-2]][2] not in ("", "html", "body"):
            todo = [k for k in self.below.get(chain[-2], ()) if k != chain[-1]]
            while todo:
                k = todo.pop()
                if self.roles[k][2] in ("h1", "h2") and self.free(k) > 0:
                    heads.add(k)
                todo += self.below.get(k, ())
        return chain[-1], heads


def article(page: str, template: Template) -> str:
    """The main text of a page."""
    seen = events(page)
    region, heads = template.region({e[1] for e in seen if e[0] == OPEN} | {ROOT})
    text = _article(seen, template, region, heads, True)
    return text or _article(seen, template, region, heads, False)


def _article(seen: list[tuple], template: Template, region: int, heads: set, by_marks: bool) -> str:
    blocks, now, own = [], [], False             # own: some of the block is no template
    stack = [(region == ROOT, False)]            # (inside, dropped)

    def part():
        nonlocal now, own
        blocks.extend(now if own else ())
        blocks.append(" ")
        now, own = [], False

    for e in seen:
        if e[0] == OPEN:
            inside, dropped = stack[-1]
            dropped = dropped or inside and (e[1] in template.junk or by_marks and e[4] == 2)
            stack.append((inside or e[1] == region or e[1] in heads, dropped))
            if e[3] not in INLINE:
                part()
        elif e[0] == CLOSE:
            stack.pop()
            if e[1] not in INLINE:
                part()
        elif e[0] == PART:
            part()
        elif e[0] == SPACE:
            now.append(" ")
        elif stack[-1] == (True, False):
            now.append(e[1])
            own = own or bool(e[1].strip()) and e[2] not in template.texts
    part()
    return " ".join("".join(blocks).split())


@lru_cache(maxsize=64)
def _template(pages: int, rows: str) -> Template:
    names = ("key", "parent", "tag", "pages", "most", "vector", "chars", "link", "marked", "up")
    return Template(pages, [[r.get(n) for n in names] for r in json.loads(rows)])


def _tokens(batches):
    for b in batches:
        names = ("key", "parent", "tag", "n", "chars", "link", "marked", "up")
        yield pd.DataFrame({"host": b["host"], "page": b["page"],
                            "tokens": [[dict(zip(names, r)) for r in token_counts(p or "")] for p in b["html"]]})


def _texts(batches):
    for b in batches:
        texts = [article(h or "", _template(int(n), t)) for h, n, t in zip(b["html"], b["n"], b["rows"])]
        yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def templates(rows: DataFrame) -> DataFrame:
    """host, n (different pages), rows (JSON of the tokens of its template)."""
    counted = (rows.select("host", "page", "html").mapInPandas(_tokens, TOKENS).dropDuplicates(["host", "page"])
               .select("host", "page", F.explode("tokens").alias("t")).select("host", "page", "t.*")
               .groupBy("host", "key")
               .agg(F.first("parent").alias("parent"), F.first("tag").alias("tag"), F.count(F.lit(1)).alias("pages"),
                    F.max("n").alias("most"), F.bit_xor(F.xxhash64("page", "n")).alias("vector"),
                    *[F.sum(c).alias(c) for c in ("chars", "link", "marked", "up")]))
    hosts = rows.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("n"))
    shared = (F.col("pages") * F.when(F.col("tag").isNull(), 2).otherwise(LAYOUTS) >= F.col("n")) \
        & ((F.col("pages") >= 2) | (F.col("n") == 1) & F.col("tag").isNotNull())
    fields = [c for c in counted.columns if c != "host"]
    return (counted.join(hosts, "host").where(shared).groupBy("host", "n")
            .agg(F.to_json(F.collect_list(F.struct(*fields))).alias("rows")))


def main_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    host = F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))
    rows = df.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).alias("url"),
                     F.coalesce(F.col(html_col), F.lit("")).alias("html"), host.alias("host"))
    rows = rows.withColumn("page", F.xxhash64("html"))
    known = stored(templates(rows), "templates")
    return (rows.join(known, "host").select("page_id", "url", "html", "n", "rows").mapInPandas(_texts, RESULT)
            .withColumn("page_id", F.col("page_id").cast("bigint")))
