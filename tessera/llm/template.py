"""HTML extraction by template deduction from equivalence classes of tokens.

1. Every page becomes blocks of text under a path of container elements, and a bag of
   tokens: its paths, and its texts (with their path).
2. Over all pages of a host, tokens with the same occurrence vector (how often on which page)
   form an equivalence class. Vectors are compared by the XOR of one hash for each (page,
   count), so a host with a third of all pages is summed map-side, one row per token.
3. A class is valid if it has several tokens and enough of the host's pages. Valid classes nest
   by their paths: a valid path is a slot of the template, and a block belongs to the deepest
   valid path above it. Texts in a valid class are the template's own words, unless all their
   pages are copies of one page; inside articles, where phrases of the story may repeat, only
   if nothing else ever fills their slot.
4. Slots are judged by all their fillings over the host: those that are mostly links, or that
   stand in containers for menus, notices, adverts, comments and the like, are not main text.
   A page's main text is what fills its article elements, or else its other slots, without the
   slots that are not main text and the template's own words. An article of which nothing would
   be left keeps its text.

Names of tags and classes mark containers to drop. A class word or a form around an article does
not drop it, if the page has no article without one and this one holds more than the page's
other text.

Hosts with fewer than ``MIN_PAGES`` pages share one template. The template of a host is bounded:
a token counts only if it is on ``TEXT_SHARE`` of the host's pages at least.

White space (as Python's ``str.split`` takes it) becomes one space, also between blocks; inline
elements don't separate words. Null or empty html, and pages without main text, give an
empty string. Null urls belong to the empty host. Repeated pages count as often as they are there.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import Scratch, others, packed, table
from tessera.llm.urltree import host_of

MIN_PAGES = 4
PATH_SHARE = 0.3                # of a host's pages, for a path to be a slot
TEXT_SHARE = 0.3                # of a host's pages, for a text to be the template's
LINK_SHARE = 0.5                # of a slot's characters, to be a menu

# Element and attribute names of HTML and of common page layouts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title iframe xmp noembed noframes".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
             "span strike strong sub sup time tt u var".split())
DROP_TAGS = set("nav footer aside form menu button select dialog noscript template svg math object canvas audio video "
                "head datalist fieldset".split())
ARTICLE_TAGS = {"article", "main"}
WRAPPERS = {"form", "fieldset"}  # may stand around a whole page
NEVER_DROP = {"html", "body", "article", "main"}
DROP_NAMES = set("ad ads adv advert adverts advertisement advertising adbox adslot banner sponsor sponsored promo promotion "
                 "cookie cookies consent gdpr notice notices alert popup modal overlay sidebar menu nav navbar navigation "
                 "breadcrumb breadcrumbs toolbar topbar footer masthead comment comments disqus reply replies respond "
                 "related recommended recommendations share sharing social newsletter subscribe subscription signup "
                 "login pagination pager widget widgets skip".split())
OUTER_DROP_NAMES = {"header"}   # outside of article elements only, as for the element <header>
DROP_ROLES = set("navigation banner contentinfo complementary search form menu menubar dialog alert".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
          "option": {"option"}, "p": {"p"}}
IN_HEAD = set("base link meta title script style noscript template".split())
SCOPES = set("ul ol dl table select article main section div body nav aside".split())

_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""\b(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")

# Bits of a container's kind, inherited by what it contains. WORDED (by a class word or a form) ends at the next
# article; the bits above count the worded containers. ELEMENT is an article proper, not just <main>.
BOILER, ARTICLE, WORDED, ELEMENT, LEVEL = 1, 2, 4, 8, 16
DROPPED = BOILER | WORDED


def _hash(s: str) -> int:
    h = xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >= 1 << 63 else h


def _kind(tag: str, attributes: str, above: int) -> tuple[str, int]:
    """A container's label (its tag and first class), and its kind below a container of kind ``above``."""
    label, names, roles = tag, [], []
    for m in _NAMES.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role":
            roles += value.lower().split()
        elif name == "itemprop":
            roles += [f"itemprop-{value.lower()}"]
        else:
            names += [w.lower() for w in _WORDS.findall(value)]
            if name == "class" and value.split():
                label = f"{tag}.{value.split()[0]}"
    kind = above
    if tag in ARTICLE_TAGS or "main" in roles or "itemprop-articlebody" in roles:
        kind = (kind | ARTICLE) & ~WORDED
        if tag == "article" or "itemprop-articlebody" in roles:
            kind |= ELEMENT
    if tag in NEVER_DROP:
        return label, kind
    if (tag in DROP_TAGS and tag not in WRAPPERS) or DROP_ROLES.intersection(roles) or (tag == "header" and not above & ARTICLE):
        kind |= BOILER
    elif tag in WRAPPERS or DROP_NAMES.intersection(names) or (not above & ARTICLE and OUTER_DROP_NAMES.intersection(names)):
        kind = (kind | WORDED) + LEVEL
    return label, kind


def blocks(page: str) -> list[tuple[str, int, str, int]]:
    """(path, kind, text, characters in links) of every non-empty block of a page, in order."""
    out: list[tuple[str, int, str, int]] = []
    stack: list[tuple[str, str, int]] = [("", "", 0)]       # tag, path, kind
    pieces: list[str] = []
    linked = depth_a = 0
    at, end = 0, len(page)

    def flush() -> None:
        nonlocal linked
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                out.append((stack[-1][1], stack[-1][2], text, min(linked, len(text))))
            pieces.clear()
        linked = 0

    def words(a: int, b: int) -> None:
        nonlocal linked
        if b > a:
            text = page[a:b]
            if "&" in text:
                text = entities.unescape(text)
            pieces.append(text)
            if depth_a:
                linked += len(text.strip())

    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            words(at, end)
            break
        words(at, m.start())
        at = m.end()
        if m[2] is None:
            continue
        tag, closing = m[2].lower(), m[1] == "/"
        attributes = m[3]
        if tag in INLINE and not (attributes and not closing and "=" in attributes and _kind(tag, attributes, 0)[1] & DROPPED):
            if closing and any(t == tag for t, _, _ in stack):      # an inline container that was pushed
                flush()
                while stack[-1][0] != tag:
                    stack.pop()
                stack.pop()
            elif tag == "a":
                depth_a = max(0, depth_a - 1) if closing else depth_a + 1
            continue
        if tag == "br" or tag in VOID:
            if tag in ("br", "hr"):
                pieces.append(" ")
            continue
        flush()
        if closing:
            if any(t == tag for t, _, _ in stack):
                while stack[-1][0] != tag:
                    stack.pop()
                stack.pop()
            depth_a = 0
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(page, at)
            at = close.end() if close else end
            continue
        if tag not in INLINE:
            closes = CLOSES.get(tag, {"p"})
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closes:
                    del stack[i:]
                    break
                if stack[i][0] in SCOPES:
                    break
        if tag not in IN_HEAD and any(t == "head" for t, _, _ in stack):     # a head that nobody closed
            while stack[-1][0] != "head":
                stack.pop()
            stack.pop()
        _, path, above = stack[-1]
        label, kind = _kind(tag, attributes, above)
        if not attributes.endswith("/>"):
            stack.append((tag, f"{path}/{label}", kind))
    flush()
    return out


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Token counts of each page: its paths (text 0) and its texts outside (1) and inside (2) of articles, with their path."""
    for batch in batches:
        columns: list[list] = [[] for _ in range(10)]
        for host, page, text, content in zip(*(batch.column(i).to_pylist() for i in range(4))):
            paths: Counter[str] = Counter()
            chars: Counter[str] = Counter()
            links: Counter[str] = Counter()
            kinds: dict[str, int] = {}
            texts: Counter[tuple[str, str]] = Counter()
            for path, kind, words, linked in blocks(text or ""):
                up = path
                while up and up not in kinds:
                    kinds[up] = 0
                    up = up.rpartition("/")[0]
                kinds[path] = kinds.get(path, 0) | kind & (DROPPED | ARTICLE)
                paths[path] += 1
                chars[path] += len(words)
                links[path] += linked
                if not kind & DROPPED:
                    texts[path, words] += 1
            slots = {p: _hash(p) for p in kinds}
            rows = [(slots[p], 0, slots[p], paths[p], k & DROPPED, chars[p], links[p]) for p, k in kinds.items()]
            rows += [(_hash(f"{p}|{w}"), 2 if kinds[p] & ARTICLE else 1, slots[p], n, 0, 0, 0) for (p, w), n in texts.items()]
            for token, is_text, slot, n, kind, c, a in rows:
                for col, v in zip(columns, (host, page, content, token, is_text, slot, n, kind, c, a)):
                    col.append(v)
        types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(),
                 pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, types)],
                                         names=["host", "page", "content", "token", "text", "slot", "n", "kind", "chars", "links"])


def deduce(pages: DataFrame, url: str, html: str, scratch: Scratch) -> DataFrame:
    """host, ``slots`` (path hash, whether it may be main text) and ``words`` (text hashes) of every template."""
    source = pages.select(host_of(F.col(url)).alias("host"), F.monotonically_increasing_id().alias("page"),
                          F.col(html).alias("html"), F.xxhash64(F.col(html)).alias("content"))
    found = source.mapInArrow(_tokens, "host string, page long, content long, token long, text int, slot long, n long, kind int, "
                                       "chars long, links long")
    vector = F.bit_xor(F.xxhash64("page", "n"))
    seen = scratch.write(found.groupBy("host", "text", "slot", "token").agg(
        vector.alias("vector"), F.count(F.lit(1)).alias("support"), F.sum("n").alias("total"),
        F.min("content").alias("content"), F.max("content").alias("content2"),
        F.max("kind").alias("kind"), F.sum("chars").alias("chars"), F.sum("links").alias("links")), "tokens")
    sizes = pages.groupBy(host_of(F.col(url)).alias("host")).agg(F.count(F.lit(1)).alias("pages"))
    grouped = sizes.withColumn("template", F.when(F.col("pages") >= MIN_PAGES, F.col("host")).otherwise(""))
    group_pages = grouped.groupBy("template").agg(F.sum("pages").alias("group_pages"))
    tokens = seen.join(grouped.select("host", "template"), "host").groupBy("template", "text", "slot", "token").agg(
        F.bit_xor("vector").alias("vector"), F.sum("support").alias("support"), F.sum("total").alias("total"),
        (F.min("content") != F.max("content2")).alias("varied"),
        F.max("kind").alias("kind"), F.sum("chars").alias("chars"), F.sum("links").alias("links")) \
        .join(group_pages, "template")
    share = F.when(F.col("text") > 0, TEXT_SHARE).otherwise(PATH_SHARE)
    tokens = scratch.write(tokens.where((F.col("support") >= MIN_PAGES) & (F.col("support") >= F.col("group_pages") * share)),
                           "frequent")
    same = ["template", "vector", "support", "total"]
    # a path stands for the start and the end of its element, so for two tokens
    classes = tokens.groupBy(*same).agg(F.sum(F.when(F.col("text") == 0, 2).otherwise(1)).alias("members")).where("members > 1")
    valid = tokens.join(classes, same)
    # inside articles a slot's texts are the template's only if they are all that fills it
    own = valid.where("text = 2 and varied").groupBy("template", "slot").agg(F.sum("total").alias("own"))
    filled = tokens.where("text = 0").select("template", "slot", F.col("total").alias("filled"))
    fixed = own.join(filled, ["template", "slot"]).where("own = filled").select("template", "slot", F.lit(True).alias("fixed"))
    valid = valid.join(fixed, ["template", "slot"], "left")
    main = (F.col("kind") == 0) & (F.col("links") <= F.col("chars") * LINK_SHARE)
    slots = F.collect_list(F.when(F.col("text") == 0, F.struct(F.col("token").alias("path"), main.alias("main"))))
    words = F.collect_list(F.when(F.col("varied") & ((F.col("text") == 1) | ((F.col("text") == 2) & F.col("fixed"))), F.col("token")))
    out = scratch.write(valid.groupBy(F.col("template").alias("host")).agg(slots.alias("slots"), words.alias("words")), "templates")
    scratch.drop("tokens", "frequent")
    return out


def main_text(page: str | None, slots: dict[int, bool], words: set[int]) -> str:
    """The page's fillings of main slots, blocks joined by one space."""
    usable = [b for b in blocks(page or "") if not b[1] & DROPPED]
    article = _articles(usable)
    if article:
        own = [b[2] for b in article if slots.get(_hash(b[0])) is not False and _hash(f"{b[0]}|{b[2]}") not in words]
        return " ".join(own or [b[2] for b in article])
    out, slot_of = [], {}
    for path, kind, text, _ in usable:
        if kind & ARTICLE:
            continue
        if path not in slot_of:
            up, verdict = path, None
            while up and verdict is None:
                verdict = slots.get(_hash(up))
                up = up.rpartition("/")[0]
            slot_of[path] = verdict is not False
        if slot_of[path] and _hash(f"{path}|{text}") not in words:
            out.append(text)
    return " ".join(out)


def _articles(usable: list[tuple[str, int, str, int]]) -> list[tuple[str, int, str, int]]:
    """The blocks of the page's articles; those in worded containers only as the docstring says."""
    article = [b for b in usable if b[1] & ARTICLE]
    plain = [b for b in article if b[1] < LEVEL]
    worded = [b for b in article if b[1] >= LEVEL]
    if not worded or any(b[1] & ELEMENT for b in plain):
        return plain
    least = min(b[1] // LEVEL for b in worded)
    worded = [b for b in worded if b[1] // LEVEL == least]
    rest = plain or [b for b in usable if not b[1] & ARTICLE]
    if sum(len(b[2]) for b in worded) <= sum(len(b[2]) for b in rest):
        return plain
    return [b for b in article if b[1] < LEVEL or b[1] // LEVEL == least]


def extract(pages: DataFrame, *, url: str = "url", html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` without the html column, with the main text (an old column of its name goes).

    Templates are joined by host: Spark ships the table while its stored size is below the
    session's broadcast limit, and splits hot hosts of the shuffled join beyond it."""
    keep = others(pages, (html, text))
    scratch = Scratch(pages.sparkSession, "template")
    templates = deduce(pages, url, html, scratch)
    shared = templates.where("host = ''").select(F.col("slots").alias("tpl_shared_slots"), F.col("words").alias("tpl_shared_words"))
    own = templates.where("host != ''").select(F.col("host").alias("tpl_host"), F.col("slots").alias("tpl_slots"),
                                               F.col("words").alias("tpl_words"))
    rows = packed(pages, keep, tpl_html=html).withColumn("tpl_key", host_of(F.col(f"row.`{url}`")))
    rows = rows.join(own, F.col("tpl_key") == F.col("tpl_host"), "left").join(F.broadcast(shared), F.lit(True), "left")
    rows = rows.select("row", "tpl_html",
                       F.coalesce("tpl_host", F.lit("")).alias("tpl_host"),
                       F.coalesce("tpl_slots", "tpl_shared_slots").alias("tpl_slots"),
                       F.coalesce("tpl_words", "tpl_shared_words").alias("tpl_words"))
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, tuple[dict[int, bool], set[int]]] = {}
        for batch in batches:
            out = []
            hosts = batch.column(2).to_pylist()
            for i, (page, host) in enumerate(zip(batch.column(1).to_pylist(), hosts)):
                if host not in known:
                    if len(known) >= 256:
                        known.clear()
                    slots, words = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
                    known[host] = {s["path"]: s["main"] for s in slots or ()}, set(words or ())
                out.append(main_text(page, *known[host]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], names=["row", "filled"])

    filled = rows.mapInArrow(fill, rows.select("row", F.lit("").alias("filled")).schema)
    return filled.select("row.*", F.col("filled").alias(text))


def op6_page_templates(spark, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
