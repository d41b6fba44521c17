"""Sentences of scanned pages in many languages, by masks and script-specific terminators in SQL expressions.

Lines are put in reading order from their boxes (columns, headlines, paragraphs, adverts), joined to a running text for each page,
masked character by character, cut, and carried back to places in the page's own text. Every mask replaces one character by one, so
places stay what they were and nothing has to be restored but the places.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Layout in widths of a page's own columns, whatever the resolution: the indents from which a line is a paragraph's first, an advert's or a
#: headline's; a box of more than WIDE widths holds several columns; an edge NEXT widths beyond a column's left edge is the next column's.
PARAGRAPH, ADVERT, HEADLINE, WIDE, NEXT = 0.025, 0.0625, 0.1, 1.4, 0.6
# Kinds of lines: body, a paragraph's first, advert, headline.
_B, _P, _A, _H = range(4)

# Private-use characters: break of paragraph; masked dot; masked terminator; neutral mark; blank in a headline; opening mark of a name; end of a short form of street; cut; opening and closing quote.
_PARA, _DOT, _END, _MARK, _GAP, _NAME, _STREET, _CUT, _OPEN, _CLOSE = (chr(0xE000 + i) for i in (0, 1, 2, 3, 4, 5, 6, 11, 16, 17))
_BLANK = r"\s"
_TERMS = ".!?…。！？।॥؟‼⁉｡"
_CJK = r"\u3005\u3041-\u30ff\u3400-\u9fff\uf900-\ufaff\x{20000}-\x{3ffff}"
_THAI = r"ก-๏๚๛"
# Line ends and blanks other than the usual ones; what lies between columns in a line read across them.
_LINE_ENDS, _BLANKS = r"[\r\x0b\f\x85\u2028\u2029]", r"(?=[\u00a0\u1680-\u3000\ufeff])[\u00a0\u1680\u2000-\u200b\u202f\u205f\u3000\ufeff]"
# Either of the two, by one look in front that most characters fail.
_ODD = r"(?=[\x0b-\r\x85\u00a0\u1680-\u3000\ufeff])[\x0b-\r\x85\u00a0\u1680\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]"
_GAPS = r"(?<=\S)(?: *\t *| {2,}\| +| {3,})(?=\S)"
_SPACES = " \t\n\x0b\f\r"
_ORNAMENT = _SPACES + "=~—–-*·•_|#+"

# Abbreviations that a name, a number or more of the sentence follows.
_TITLES = [
    "Dr", "Mr", "Mrs", "Ms", "Messrs", "Capt", "Col", "Gen", "Lieut", "Lt", "Sgt", "Rev", "Hon", "Prof", "No", "Nos", "viz", "i.e", "e.g", "cf", "pp", "p", "vol",
    "Hr", "Hrn", "Frl", "d", "h", "z", "u", "a", "vgl", "S", "Nr", "bzw", "geb", "M", "MM", "Mgr", "ex", "v", "r", "Sr", "Sra", "Srta", "Sres", "Dña", "Excmo",
    "pág", "núm", "c", "ej", "т", "е", "ул", "им", "стр", "гр", "см", "κ", "κκ", "π", "χ", "σ", "αρ", "डॉ", "रु", "पं", "د", "م", "ص",
]
# Months and the like, before which a number with a dot is an ordinal.
_ORDINAL = "Januar|J(?:ä|a\u0308)nner|Februar|M(?:ä|a\u0308)rz|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jahrhundert|Jahrh"
# Small words at the end of a line of a headline, which then goes on.
_SMALL = "on|in|of|at|near|the|a|an|for|aus|bei|von|en|de|del|la|el|du|des|le|à|в|у|на|στην|στη|στο|στον"
# Words that follow a quotation and belong to it, where letters have no case.
_SAID_AFTER = r"[\s]*(?:صاح|سأل|هتف|أجاب|نادى)|[\s]*(?=[\u0900-\u0963])[^।॥|!?\ue000\ue002\ue010\ue011]+?ने\s(?:कहा|पूछा)"
_SAID_CJK = r"\s*と|\s*(?=[\u3400-\u9fff])[^。！？，\ue000\ue002\ue010\ue011]*(?:喊\n?道|说\n?道|问\n?道|答\n?道|叫\n?道)"
# How headings of adverts end or begin where letters have no case.
_CASELESS_HEADING = r"(?:का मरहम|药膏|軟膏)\s*$|^\s*(?:ยาหม่อง|مرهم )"
# Stock phrases that sentences of adverts begin with.
_ADVERT_START = (
    r"^\s*(?:☞|Sold by|No house|Try it|Terms:|Apply to|Price|Zu haben|Nur einmal|Preis|Essayez|Prix|Chez|¡Pruébelo|Razón:|Precio:|"
    r"Попробуйте|Спросить|Цена|Δοκιμάστε|Τιμή|Οδός|جربوه|الثمن|एक बार|मूल्य|ลองดู|ราคา|一试|每盒|一度お試し|一箱)"
)


def _sub(c: Column, pattern: str, to: str) -> Column:
    return F.regexp_replace(c, F.lit(pattern), F.lit(to))


def _let(c: Column, use) -> Column:
    """``use`` of a value that is computed once, as a lambda's variable."""
    return F.get(F.transform(F.array(c), use), F.lit(0))


def _if_has(c: Column, chars: str, change) -> Column:
    """``change`` only for texts with a character of the class, given as one character or as ranges."""
    return _let(c, lambda x: F.when(x.contains(chars) if len(chars) == 1 else x.rlike(f"[{chars}]"), change(x)).otherwise(x))


def _ornament(c: Column) -> Column:
    """Whether a line has nothing but ornaments and blanks."""
    return F.ltrim(c, F.lit(_ORNAMENT)) == ""


def _capitals(c: Column) -> Column:
    letters = F.length(_sub(c, r"[^\p{Lu}\p{Ll}]", ""))
    return (letters >= 3) & (F.length(_sub(c, r"[^\p{Lu}]", "")) >= letters * 0.8)


def _ended(c: Column) -> Column:
    return c.rlike(rf"[{_TERMS};|][\"'”“»«’)\]）」』]*[{_BLANK}]*$")


def _starts(items: Column, size, first: Column) -> Column:
    """Where each of consecutive items starts, and where the last ends."""
    return F.aggregate(items, F.array(first), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + size(x)))


def _width(widths: Column, gapped: Column) -> Column:
    """A page's column width by the widths of its boxes: the upper quartile of those of lines without a gap inside, as others may be read across.

    On a page with such lines that quartile counts only widths up to WIDE times the lower one; where every line has a gap, it is half of the largest width.
    """

    def upper(s: Column) -> Column:
        return F.get(s, F.floor(F.size(s) * 3 / 4).cast("int"))

    def single(s: Column) -> Column:
        least = F.get(s, F.floor(F.size(s) / 4).cast("int")) * WIDE
        return F.when(F.size(s) == 0, F.array_max(widths) / 2).otherwise(upper(F.filter(s, lambda w: w <= least)))

    return F.when(gapped.isNull(), upper(F.sort_array(widths))).otherwise(_let(F.sort_array(F.filter(widths, lambda w, i: ~F.get(gapped, i))), single)).cast("double")


def _edges(x0s: Column, width: Column) -> Column:
    """Left edges of a page's columns, from left to right."""

    def more(acc: Column, x: Column) -> Column:
        return F.when(x > F.element_at(acc, -1) + width * NEXT, F.array_append(acc, x)).otherwise(acc)

    first = F.array(F.array_min(x0s))
    return F.when(F.array_max(x0s) <= F.array_min(x0s) + width * NEXT, first).otherwise(F.aggregate(F.sort_array(x0s), first, more))


def _place(x0: Column, lefts: Column, width: Column) -> Column:
    """4 times the column in which a line begins, plus the kind that its indent tells."""
    second, third = F.get(lefts, F.lit(1)), F.get(lefts, F.lit(2))
    col = F.when(F.coalesce(x0 < second, F.lit(True)), 0).when(F.coalesce(x0 < third, F.lit(True)), 1).otherwise(F.size(F.filter(lefts, lambda e: e <= x0)) - 1)
    indent = x0 - F.get(lefts, col)
    return col * 4 + F.when(indent < width * PARAGRAPH, _B).when(indent < width * ADVERT, _P).when(indent < width * HEADLINE, _A).otherwise(_H)


def _row(k: Column, at: Column, txt: Column, kind: Column, col: Column, caps: Column) -> Column:
    return F.struct((col * 2 + (kind == _A).cast("int")).cast("int").alias("order"), k.cast("int").alias("k"), at.cast("int").alias("at"), txt.alias("txt"), kind.cast("int").alias("kind"), caps.alias("caps"))


def _told(rows: Column) -> Column:
    """Rows (_row) of the pieces of a page's lines, in reading order, with their kinds.

    A right piece has no box of its own (``unsure``): the first of a column is a headline, lines in capitals are headings, those inside a
    sentence of adverts, and a line that had room for the next line's first word ends its paragraph.
    """
    cols = F.sequence(F.lit(0), F.coalesce(F.array_max(F.transform(rows, lambda r: r["col"])), F.lit(0)))
    most = F.transform(cols, lambda c: F.array_max(F.transform(F.filter(rows, lambda r: (r["col"] == c) & r["unsure"]), lambda r: r["size"])))

    def step(most: Column):
        def kind_of(acc: Column, r: Column, w: Column) -> Column:
            prev = w["prev"]
            more = prev.rlike(r"[-‐¬=\u00ad]\s*$") | prev.rlike(rf"(?i)(?:^|\s)(?:{_SMALL})\s*$")
            titled = F.coalesce((w["nth"] == 1) | ((w["nth"] == 2) & (more | (r["caps"] & _capitals(prev)) | r["txt"].rlike(r"^\s*\p{Ll}"))), F.lit(False))
            heading = r["unsure"] & ~titled & (r["caps"] | r["txt"].rlike(_CASELESS_HEADING))
            left = F.coalesce(_ended(prev), F.lit(True)) & ~r["txt"].rlike(_ADVERT_START)
            word = F.when(r["txt"].rlike(rf"^\s*[{_CJK}{_THAI}]"), F.lit(2)).otherwise(F.length(F.regexp_extract(r["txt"], rf"^\s*[^{_BLANK}]*", 0)) + 1)
            short = ~r["txt"].rlike(r"^\s*\p{Ll}") & (F.get(most, r["col"]) - F.length(F.rtrim(prev)) > word + 1)

            def kept(advert: Column) -> Column:
                kind = F.when(~r["unsure"], r["kind"]).when(titled, _H).when(advert, _A).when(short, _P).otherwise(_B)
                return F.struct(F.array_append(acc["kinds"], kind).alias("kinds"), r["col"].alias("col"), w["nth"].alias("nth"), r["txt"].alias("prev"), advert.alias("open"))

            return _let(heading | (w["open"] & r["unsure"] & ~left), kept)

        def one(acc: Column, r: Column) -> Column:
            same = acc["col"] == r["col"]
            w = F.struct(F.when(same, acc["prev"]).alias("prev"), F.when(same, acc["nth"] + 1).otherwise(1).alias("nth"), (same & acc["open"]).alias("open"))
            return _let(w, lambda w: kind_of(acc, r, w))

        return one

    zero = F.struct(F.array().cast("array<int>").alias("kinds"), F.lit(-1).alias("col"), F.lit(0).alias("nth"), F.lit("").alias("prev"), F.lit(False).alias("open"))
    # only kinds are carried from step to step: what a step carries is copied
    kinds = _let(most, lambda m: F.aggregate(rows, zero, step(m), lambda acc: acc["kinds"]))
    return F.sort_array(F.zip_with(rows, kinds, lambda r, kind: _row(r["k"], r["at"], r["txt"], kind, r["col"], r["caps"])))


def page_lines(df: DataFrame, doc_id: str, text: str, boxes: str | None) -> DataFrame:
    """(doc, rows): for each page an array of its non-blank lines and pieces of lines (order, k, at, txt, kind, caps) in reading order.

    ``order`` is twice the column, plus 1 for adverts, which come behind the body of their column. ``at`` is a line's place in the page's text; ``caps`` marks
    headlines and adverts in capitals. Lines read across columns are split at their gaps.
    A page is done within its row: nothing is shuffled.
    """
    x0s, x1s = (F.col(boxes).getField(c).cast("array<int>") if boxes else F.lit(None).cast("array<int>") for c in ("x0", "x1"))
    docs = df.select(F.col(doc_id).alias("doc"), F.col(text).alias("t"), x0s.alias("x0s"), x1s.alias("x1s"))
    docs = docs.where(F.col("doc").isNotNull() & F.col("t").isNotNull() & (F.ltrim(F.col("t"), F.lit(_SPACES)) != ""))
    # one mark for all line ends and one for all blanks, a character for a character
    plain = F.when(F.col("t").rlike(_ODD), _sub(_sub(F.col("t"), _LINE_ENDS, "\n"), _BLANKS, " ")).otherwise(F.col("t"))
    docs = docs.select("doc", "x0s", "x1s", plain.alias("t"))
    # lines with the blank ones that follow them; blank ones before the first are a part of their own
    may_gap = F.col("t").contains("   ") | F.col("t").contains("\t") | F.col("t").contains("  |")
    p = docs.select("doc", "x0s", "x1s", F.split("t", r"\n(?=[ \t]*\S)").alias("parts"), may_gap.alias("may_gap"))
    head = F.get("parts", F.lit(0))
    blank_first = F.trim(head, F.lit(" \t\n")) == ""
    p = p.select("doc", "x0s", "x1s", "may_gap", F.when(blank_first, F.length(head) + 1).otherwise(0).alias("from"), F.when(blank_first, F.slice("parts", 2, F.greatest(F.size("parts"), F.lit(1)))).otherwise(F.col("parts")).alias("parts"))
    fits = F.coalesce((F.size("parts") == F.size("x0s")) & ~F.array_contains(F.transform(F.array("x0s", "x1s"), lambda a: F.size(F.array_compact(a)) < F.size(a)), True), F.lit(False))
    p = p.select("doc", "x0s", "x1s", "may_gap", "parts", _starts(F.col("parts"), lambda s: F.length(s) + 1, F.col("from")).alias("starts"), fits.alias("fits"))
    gapped = F.when(F.col("may_gap") & F.col("fits"), F.transform("parts", lambda s: s.rlike(_GAPS)))
    p = p.select("doc", "parts", "starts", "x0s", F.when(F.col("fits"), F.zip_with("x1s", "x0s", lambda a, b: a - b)).alias("widths"), gapped.alias("gapped"))
    p = p.select("doc", "parts", "starts", "x0s", "widths", "gapped", F.when(F.col("widths").isNotNull(), _width(F.col("widths"), F.col("gapped"))).alias("width"))
    p = p.select("doc", "parts", "starts", "x0s", "widths", "gapped", "width", F.when(F.col("width").isNotNull(), _edges(F.col("x0s"), F.col("width"))).alias("lefts"))
    across = F.col("gapped").isNotNull() & (F.array_max("widths") > F.col("width") * WIDE)
    places = F.when(F.col("lefts").isNotNull(), F.transform("x0s", lambda x: _place(x, F.col("lefts"), F.col("width"))))
    p = p.select("doc", "parts", "starts", "widths", "width", places.alias("places"), across.alias("across"))

    def line_of(part: Column) -> Column:
        return F.substring_index(part, "\n", 1)

    def boxed_row(part: Column, i: Column) -> Column:
        place, txt = F.get("places", i), line_of(part)
        kind = place.bitwiseAND(3)
        return _row(i, F.get("starts", i), txt, kind, F.shiftright(place, 2), F.when(kind >= _A, _capitals(txt)).otherwise(F.lit(False)))

    def bare_row(part: Column, i: Column) -> Column:
        caps = _capitals(line_of(part))
        kind = F.when(caps, _H).when((i == 0) | F.get("parts", i - 1).contains("\n"), _P).otherwise(_B)
        return _row(i, F.get("starts", i), line_of(part), kind, F.lit(0), caps)

    def cut_up(part: Column, i: Column) -> Column:
        across = F.get("widths", i)
        spanned = F.when(across > F.col("width") * WIDE, F.greatest(F.lit(2), F.round(across / F.col("width")).cast("int"))).otherwise(1)

        def texts(w: Column) -> Column:
            gaps = F.transform(F.regexp_extract_all(w["txt"], F.lit(_GAPS), F.lit(0)), lambda g: F.length(g))
            return F.struct(
                i.alias("k"), F.get("starts", i).alias("start"), F.shiftright(F.get("places", i), 2).alias("col"), F.get("places", i).bitwiseAND(3).alias("kind"),
                F.split(w["txt"], _GAPS, w["n"]).alias("texts"), F.slice(gaps, F.lit(1), w["n"] - 1).alias("gaps"),
            )

        return _let(F.struct(line_of(part).alias("txt"), spanned.alias("n")), texts)

    def spread(lines: Column) -> Column:
        def of_line(s: Column, least: Column) -> Column:
            def piece(txt: Column, j: Column, offs: Column) -> Column:
                # a gap wider than usual holds a blank at the end of the left line
                padded = F.concat(txt, F.repeat(F.lit(" "), F.coalesce(F.get(s["gaps"], j) - least, F.lit(0))))
                caps = F.when((j > 0) | (s["kind"] >= _A), _capitals(txt)).otherwise(F.lit(False))
                return F.struct(
                    (s["col"] + j).alias("col"), s["k"].alias("k"), F.get(offs, j).alias("at"), padded.alias("txt"), (j > 0).alias("unsure"),
                    s["kind"].alias("kind"), caps.alias("caps"), F.length(F.rtrim(txt)).alias("size"),
                )

            sizes = F.transform(s["texts"], lambda x, j: F.length(x) + F.coalesce(F.get(s["gaps"], j), F.lit(0)))
            return _let(_starts(sizes, lambda n: n, s["start"]), lambda offs: F.transform(s["texts"], lambda x, j: piece(x, j, offs)))

        least = F.array_min(F.flatten(F.transform(lines, lambda s: s["gaps"])))
        pieces = _let(least, lambda m: F.flatten(F.transform(lines, lambda s: of_line(s, m))))
        return _let(F.sort_array(F.filter(pieces, lambda r: ~_ornament(r["txt"]))), _told)

    def lines(row) -> Column:
        return F.sort_array(F.filter(F.transform("parts", row), lambda r: ~_ornament(r["txt"])))

    rows = F.when(F.col("places").isNull(), lines(bare_row)).when(F.col("across"), _let(F.transform("parts", cut_up), spread)).otherwise(lines(boxed_row))
    return p.select("doc", rows.alias("rows"))


def _running(rows: Column) -> Column:
    """The rows' texts, with a mark in front of those that begin a paragraph; headlines and advert headings masked, a character for a character."""

    def neutral(r: Column) -> Column:
        return F.translate(r["txt"], _TERMS + " ;|\"“”„«»'‘’「」『』()（）", _END * len(_TERMS) + _GAP + _MARK * 20)

    def piece(r: Column, fresh: Column, head: Column) -> Column:
        return F.concat(F.when(fresh, _PARA).otherwise(""), F.when(head, neutral(r)).otherwise(r["txt"]))

    def without_adverts(r: Column, i: Column) -> Column:
        p = F.get(rows, i - 1)
        fresh = (i == 0) | (p["order"] != r["order"]) | (r["kind"] == _P) | ((r["kind"] == _H) != (p["kind"] == _H))
        return piece(r, fresh, r["kind"] == _H)

    def begins(r: Column, i: Column) -> Column:
        p = F.get(rows, i - 1)
        first = (i == 0) | (p["order"] != r["order"])
        return (r["kind"] == _A) & (first | r["txt"].rlike(_CASELESS_HEADING) | (r["caps"] & ~p["caps"] & _ended(p["txt"])))

    def heads(starts: Column) -> Column:
        def head(r: Column, i: Column) -> Column:
            goes_on = (r["kind"] == _A) & (i > 0) & F.coalesce(F.get(starts, i - 1), F.lit(False)) & r["caps"] & F.coalesce(F.get(rows, i - 1)["caps"], F.lit(False))
            return (r["kind"] == _H) | F.get(starts, i) | goes_on

        return F.transform(rows, head)

    def finished(starts: Column, head: Column) -> Column:
        def one(r: Column, i: Column) -> Column:
            p = F.get(rows, i - 1)
            fresh = (i == 0) | (p["order"] != r["order"]) | (r["kind"] == _P) | F.get(starts, i) | (F.get(head, i) != F.get(head, i - 1))
            return piece(r, fresh, F.get(head, i))

        return F.transform(rows, one)

    with_adverts = _let(F.transform(rows, begins), lambda starts: _let(heads(starts), lambda head: finished(starts, head)))
    return F.when(F.exists(rows, lambda r: r["kind"] == _A), with_adverts).otherwise(F.transform(rows, without_adverts))


def mask(c: Column) -> Column:
    """Dots that end nothing, quotations and brackets, character by character."""
    titles: dict[int, list[str]] = {}
    for a in dict.fromkeys(unicodedata.normalize(form, a) for a in _TITLES for form in ("NFC", "NFD")):
        titles.setdefault(len(a), []).append(a)
    word, upper = r"(?<![\p{L}\p{M}\p{N}½¼¾])", r"(?=\s+\p{Lu})"
    dots = [
        r"(?<=\p{N}\.)(?=\n?\p{N})",  # decimals
        rf"(?=[\p{{L}}\p{{N}}&&[^{_CJK}]])(?!(?<=(?:\p{{Ll}}{{2}}|[ap].m|½d)\.)\p{{Lu}}[\p{{Ll}}\s])",  # inside words and addresses
        r"(?=[-/@,;:])",
        rf"(?<={word}\p{{Lu}}\.){upper}",  # initials
        # one look back for each length
        rf"(?=[\s\p{{L}}])(?:{'|'.join(f'(?<={word}(?:{chr(124).join(x.replace(chr(46), chr(92) + chr(46)) for x in same)})' + chr(92) + '.)' for same in titles.values())})",
        rf"(?<={word}St\.)(?=\s)",  # a saint; a street with a number has another mark by now
        rf"(?<=\p{{N}}\.)(?=\s+(?:{_ORDINAL}))",
        rf"(?<={word}[AaIi]m\s\p{{N}}{{1,2}}\.)(?=\s)",
        r"(?=\s+[½¼¾⅓⅔⅛])",
        r"(?<=(?i:str|straße|strasse)\.)(?=\s+\p{N})",
        rf"(?<=[{_THAI}]\.)",
        r"(?<=\p{N}s\.)(?=\s+\p{N})",
        r"(?<=\s[вВ]\sг\.)",
        rf"(?<={word}д\.)(?=\s+\p{{N}})",
    ]
    c = _let(c, lambda x: F.when(x.contains("St."), _sub(x, r"(\p{N}\s\p{L}++\sS)t(?=\.)", f"$1{_STREET}")).otherwise(x))
    c = _sub(c, rf"\.(?:{'|'.join(dots)})", _DOT)
    # a raised dot read for a dot, where a sentence begins behind it
    c = _if_has(c, "·", lambda x: _sub(x, r"·(?<=[\p{L}\p{N})”»]·)(?<![\u0370-\u03ff\u1f00-\u1fff]·)(?=\s+\p{Lu})", "."))
    # ellipses that the sentence goes on behind
    c = _if_has(c, "…", lambda x: _sub(x, r"…(?=…|\s*[\p{Ll}\p{Lo}])", _MARK))
    # a bar for the danda; the Greek question mark
    c = _if_has(c, "|", lambda x: _sub(x, r"\|(?<=[ऀ-ॿ]\s{0,2}\|)", "।"))
    c = _if_has(c, ";", lambda x: _sub(x, r"[;;](?<=[\u0370-\u03ff\u1f00-\u1fff\u0300\u0301][;;])", "؟"))
    # quotations: opening and closing marks of all styles become one pair
    inner = rf"[^{_PARA}{_OPEN}{_CLOSE}"
    c = _if_has(c, "„", lambda x: _sub(x, rf"„({inner}„“”]++)[“”]", f"{_OPEN}$1{_CLOSE}"))
    c = _if_has(c, "“", lambda x: _sub(x, rf"“({inner}“”]++)”", f"{_OPEN}$1{_CLOSE}"))
    german = rf"»(?<=(?:^|[\s{_PARA}(—])»)(?=[\p{{L}}\p{{N}}])({inner}«»]++)«(?![\p{{L}}\p{{N}}])"
    # from a mark right behind a word and before a blank to one right before a word is what lies between two quotations
    french = rf"«({inner}«»]++(?=»(?![\p{{L}}\p{{N}}]))|(?!(?<=[^\s{_PARA}(\[—–:-]«)\s){inner}«»]++)»"
    c = _if_has(c, "«", lambda x: _sub(_sub(x, german, f"{_OPEN}$1{_CLOSE}"), french, f"{_OPEN}$1{_CLOSE}"))
    c = _if_has(c, '"', lambda x: _sub(x, rf'"({inner}"]++)"', f"{_OPEN}$1{_CLOSE}"))
    c = _let(c, lambda x: F.when(x.contains("''"), _sub(x, rf"''({inner}]+?)''", f"{_OPEN}{_MARK}$1{_MARK}{_CLOSE}")).otherwise(x))
    c = _if_has(c, "『", lambda x: _sub(x, rf"『({inner}『』]++)』", f"{_NAME}$1{_MARK}"))
    c = _if_has(c, "「", lambda x: _sub(x, rf"「({inner}「」]++)」", f"{_OPEN}$1{_CLOSE}"))
    # what ends nothing inside quotations and brackets
    c = _if_has(c, _CLOSE, lambda x: _inside(x, _OPEN, _CLOSE))
    c = _if_has(c, "(", lambda x: _inside(x, "(", ")"))
    return _if_has(c, "（", lambda x: _inside(x, "（", "）"))


def _inside(c: Column, open_: str, close: str) -> Column:
    """Terminators masked between each opening mark and the next closing one, unless a paragraph ends between."""

    def part(e: Column, i: Column) -> Column:
        head = F.substring_index(e, close, 1)
        pair = (i > 0) & e.contains(close) & ~head.contains(_PARA)
        return F.when(pair, F.concat(F.translate(head, _TERMS, _END * len(_TERMS)), F.substr(e, F.length(head) + 1))).otherwise(e)

    return F.array_join(F.transform(F.split(c, "\\(" if open_ == "(" else open_), part), open_)


def cut(c: Column) -> Column:
    """A cut mark behind each sentence of the masked text."""
    close = rf"[{_CLOSE}{_MARK})\]）」』\"'”’»“«]*"
    start = rf"(?:[\p{{Lu}}\p{{Lt}}\p{{Lo}}\p{{N}}{_OPEN}{_NAME}(\[（¿¡☞£$€§«»„“”\"'‘]|[—–-]\s?[\p{{Lu}}¿¡])"
    ahead = rf"(?=\s+(?:[|~·'*,•]\s+)?{start})"
    lost_blank = r"(?<=(?:\p{Ll}{2}|[ap].m|½d)[.!?])(?=\p{Lu}[\p{Ll}\s]|☞)"
    others = "…।॥؟‼⁉"
    c = _if_has(c, r"\u0600-\u2050", lambda x: _sub(x, rf"(?=[\u061f-\u2049])[{others}]", "!"))
    # patterns begin with the character they look for: a group in front would be tried at every place
    c = _sub(c, rf"[.!?](?:[.!?]*{close}{ahead}|{lost_blank})", f"$0{_CUT}")
    quoted = rf"{_END}(?:\s?{_MARK}?{_CLOSE}[)\]]?{ahead}(?!{_SAID_AFTER}|{_SAID_CJK}|\s+[{_THAI}])|[)）\]]{ahead})"
    c = _if_has(c, _END, lambda x: _sub(x, quoted, f"$0{_CUT}"))
    han = rf"[{_CJK}]"
    full = rf"[。！？｡]+{close}(?!{_CUT})"
    half = rf"[.!?](?<={han}[^{_PARA}]{{0,2}}[.!?])(?![.!?]){close}(?=\s*(?:{han}|[{_OPEN}{_NAME}「『（]))"
    said = rf"{_END}{_MARK}?{_CLOSE}(?=\s*(?:{han}|[{_OPEN}{_NAME}「『（{_MARK}\p{{N}}]))(?!{_SAID_CJK})"
    c = _if_has(c, r"\u3041-\u9fff", lambda x: _sub(_sub(_sub(x, full, f"$0{_CUT}"), half, f"$0{_CUT}"), said, f"$0{_CUT}"))
    c = _if_has(c, r"\u0e01-\u0e5b", lambda x: _sub(x, rf"[{_THAI}!?][ \t]+(?=\n?[{_THAI}])", f"$0{_CUT}"))
    return F.replace(c, F.lit(_PARA), F.lit(_CUT + _PARA))


def _spans(pages: DataFrame) -> DataFrame:
    """(doc, x): start times 2**32 plus end of each sentence of a page's running text, in places of the page's text.

    ``pages`` has doc, run and shifts, the way to the page's text for each line. Values used more than once are columns: those bound inside a lambda
    are copied each time.
    """

    def lines(c: Column) -> Column:
        return F.octet_length(c) - F.octet_length(F.replace(c, F.lit("\n"), F.lit("")))

    def speck(b: Column) -> Column:
        return F.lit("|~·*•,'").contains(F.substring(b, 1, 1)) & F.substring(b, 1, 2).rlike(r"^[|~·*•,'](?:\s|$)")

    def speckless(b: Column) -> Column:
        return F.when(speck(b), F.ltrim(F.substr(b, F.lit(2)), blank)).otherwise(b)

    def step(acc: Column, u: Column) -> Column:
        i, t = acc["i"], F.get("trimmed", acc["i"])
        at, line = acc["at"] + F.get("leads", i), acc["line"] + F.get("lead_lines", i)
        span = F.shiftleft((at + F.get("shifts", line)).cast("bigint"), 32) + (at + F.length(t) + F.get("shifts", line + lines(t)))
        out = F.when(t.rlike(r"[\p{L}\p{N}]"), F.array_append(acc["out"], span)).otherwise(acc["out"])
        return F.struct((i + 1).alias("i"), (acc["at"] + F.length(u)).alias("at"), (acc["line"] + lines(u)).alias("line"), out.alias("out"))

    blank = F.lit(f" \t\n{_PARA}{_GAP}")
    p = pages.select("doc", "shifts", F.split(cut(mask(F.col("run"))), _CUT).alias("units"))
    p = p.select("doc", "shifts", "units", F.transform("units", lambda u: F.ltrim(u, blank)).alias("rest"))
    p = p.select("doc", "shifts", "units", F.when(F.exists("rest", speck), F.transform("rest", speckless)).otherwise(F.col("rest")).alias("rest"))
    leads, trimmed = F.zip_with("units", "rest", lambda u, b: F.length(u) - F.length(b)), F.transform("rest", lambda b: F.rtrim(b, blank))
    p = p.select("doc", "shifts", "units", leads.alias("leads"), trimmed.alias("trimmed"))
    p = p.select("doc", "shifts", "units", "leads", "trimmed", F.zip_with("units", "leads", lambda u, n: lines(F.substr(u, F.lit(1), n))).alias("lead_lines"))
    zero = F.struct(F.lit(0).alias("i"), F.lit(0).alias("at"), F.lit(0).alias("line"), F.array().cast("array<bigint>").alias("out"))
    return p.select("doc", F.aggregate("units", zero, step, lambda acc: acc["out"]).alias("x"))


def sentences(df: DataFrame, doc_id: str = "doc_id", text: str = "text", boxes: str | None = "line_boxes") -> DataFrame:
    """(doc_id, start_char int, end_char int): each sentence of each text, 0-based, in code points, the end exclusive.

    The i-th of ``boxes`` belongs to the i-th non-blank line. Columns, headlines, paragraphs and adverts are told by their boxes;
    without boxes, or where they don't fit the lines, lines are read in their order, blank lines part paragraphs and
    lines in capitals are headlines. A headline, an advert's heading, and each sentence of an advert are units; what an advert, an
    ornament or the neighbouring column interrupts is one unit from its first to its last character.

    Null, empty and blank texts, and rows with a null ``doc_id``, have no sentences. Repeated rows count once; different texts under one doc_id all count.
    Texts and quotations are cut whole, however long; a quotation ends with its paragraph at the latest. A page is done within its row; only
    doc_ids and places are shuffled, to find repeated rows.
    """
    pages = page_lines(df, doc_id, text, boxes)
    pages = pages.select("doc", "rows", _running(F.col("rows")).alias("texts"))
    # bound once: Spark would move a column that is used in one place only into the lambda, to be computed for each row
    flow = _starts(F.col("texts"), lambda t: F.length(t) + 1, F.lit(0))
    shifts = _let(flow, lambda f: F.transform("rows", lambda r, i: r["at"] + F.length(r["txt"]) - F.length(F.get("texts", i)) - F.get(f, i)))
    spans = _spans(pages.select("doc", F.array_join("texts", "\n").alias("run"), shifts.alias("shifts"))).groupBy("doc").agg(F.collect_set("x").alias("x"))
    spans = spans.select("doc", F.explode(F.when(F.size("x") == 1, F.get("x", F.lit(0))).otherwise(F.array_distinct(F.flatten("x")))).alias("x"))
    return spans.select(F.col("doc").alias(doc_id), F.shiftright("x", 32).cast("int").alias("start_char"), F.col("x").bitwiseAND(0xFFFFFFFF).cast("int").alias("end_char"))
