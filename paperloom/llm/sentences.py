"""Sentence boundaries across languages and scripts, in SQL expressions.

Signs that look like ends but are none (in decimals, abbreviations, initials, formulas,
quotations, brackets and list items) are masked by noncharacters, one for one, so that places
in the text stay valid. Separators go in after the terminators of each script that remain, and
the pieces between them are the units; the text of a unit is cut from the original.

All of it is computed within the row of a document: no shuffle, no Python, linear in its text.

Defined results
---------------
* Null, empty and blank texts have no units.
* A text without any terminator is one unit per line that is a heading or list item, else one.
* Rows repeated whole give repeated units; an empty table gives an empty table.
* A position counts Unicode code points from the start of the text.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Noncharacters that never stand in text; those that do are replaced by U+FFFD first.
SEP, DOT, STOP, LINE, OPEN, CLOSE, TOLD = (chr(0xFDD0 + i) for i in range(7))
_RESERVED = "".join(chr(0xFDD0 + i) for i in range(32))

#: Blanks that are no ASCII white space; for finding ends they are like any blank (fixed values).
SPACE = "".join(map(chr, (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
BLANKS = "\u00a0\u1680" + "".join(chr(0x2000 + i) for i in range(11)) + "\u202f\u205f\u3000"

#: Abbreviations that never end a sentence before a name, number or bracket (fixed values).
ABBREVIATIONS = (
    # English
    "Dr Prof Mr Mrs Ms St Fig Figs Eq Eqs Sec Secs App Ref Refs Thm Lem Prop Cor Def Chap Ch Vol vol No Nos Tab "
    "cf Cf vs viz ca approx Jan Feb Mar Apr Jun Jul Aug Sep Sept Oct Nov Dec pp ed eds resp "
    # German
    "Kap Abschn Gl Bd Fa Nr Abb vgl Vgl bzw Hrsg Tel Str sog Jh "
    # French
    "fig éq chap exp env MM p av Av "
    # Spanish
    "pág págs cap ec núm aprox Sr Sra Dra Ud Uds Véase EE "
    # Italian
    "sig dott pag Cfr cfr prof ing "
    # Russian
    "проф акад рис Рис гл стр см См напр ок ул им табл разд "
    # Hindi, Arabic, Thai
    "डॉ प्रो पृ ई सं श्री د أ ص م ดร ศ รศ ผศ"
).split()
#: Spaced or closed pairs whose last point ends nothing either (fixed values).
PAIRS = "i.e e.g z.B d.h u.a o.ä p.ej i.e т.е ad.es"
#: What follows a number with a point that is an ordinal (fixed values).
ORDINAL = (
    "Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Jan|Feb|Apr|Aug|Sept|Okt|"
    "Nov|Dez|Jahrhundert|Jahrhunderts|Jh|Auflage|Aufl|Kapitel|Ordnung|Klasse|Grad|Mal|Tag|Woche|Band"
)
_END = ".!?…؟"
_LABEL = r"[ \t]*(?:[•▪‣◦*-][ \t]|\(?\d{1,3}\)[ \t]|\d{1,3}\.[ \t]|\[\d{1,4}\][ \t])"
_HASH = r"[ \t]*#{1,6}[ \t]"
_START = rf"(?:[({OPEN}¿¡]\s?)*(?:\p{{Lu}}|\p{{Lt}}|\p{{Ll}}{{1,2}}\p{{Lu}})"


def _sub(x: Column, *pairs: tuple[str, str]) -> Column:
    for pattern, to in pairs:
        x = F.regexp_replace(x, F.lit(pattern), F.lit(to))
    return x


def _let(x: Column, body) -> Column:  # noqa: ANN001
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(x), body), F.lit(0))


def _hide(x: Column) -> Column:
    """All terminators of a text masked."""
    return F.translate(x, ".!?…؟。！？．।", DOT + STOP * 9)


def _parity(x: Column, mark: str, inside, before=None, after=None) -> Column:  # noqa: ANN001
    """Applies functions to the stretches between pairs of ``mark`` and beside them; unpaired marks change nothing."""
    def at(s: Column, i: Column, n: Column) -> Column:
        out = F.when(i % 2 == 1, inside(s))
        if before is None:
            return out.otherwise(s)
        return (
            out.when(i == 0, before(s))
            .when(i == n - 1, after(s))
            .otherwise(_let(after(s), before))
        )

    def paired(parts: Column) -> Column:
        return F.when(F.size(parts) % 2 == 1, F.transform(parts, lambda s, i: at(s, i, F.size(parts)))).otherwise(parts)

    def whole(v: Column) -> Column:
        done = F.array_join(_let(F.split(v, mark.replace("$", r"\$")), paired), mark)
        return F.when(F.contains(v, F.lit(mark)), done).otherwise(v)

    return _let(x, whole)


def _formulas(x: Column) -> Column:
    """Displayed formulas belong to the sentence around them."""
    return _parity(
        x, "$$",
        inside=lambda s: F.translate(_hide(s), "\n", LINE),
        before=lambda s: _sub(s, (r"\n(?=[ \t\r]*$)", LINE)),
        after=lambda s: _sub(s, (rf"^([ \t\r]*)\n(?=[ \t]*(?:\p{{Ll}}|[,;.]))", f"$1{LINE}")),
    )


#: Web and mail addresses and DOIs, without the point or comma that ends the sentence around them (fixed values).
ADDRESS = (
    r"(?i:(?:(?:https?|ftp)://|www\.)[^\s<>]*[^\s<>.,;:!?)\]}\"'”»…。，]|\b[\w.+-]+@[\w-]+(?:\.[\w-]+)*\.[a-z]{2,}\b"
    r"|\b10\.\d{4,9}/[^\s<>]*[^\s<>.,;:!?)\]}\"'”»…]|\b[\w-]+(?:\.[\w-]+)*\.(?:com|org|net|edu|gov)\b(?:/[^\s<>]*[^\s<>.,;:!?)\]}\"'])?)"
)
_ADDRESSED = r"(?i)://|www\.|@|\b10\.\d{4}|\.(?:com|org|net|edu|gov)\b"


def _addresses(x: Column) -> Column:
    """Terminators within addresses masked."""
    def hidden(parts: Column) -> Column:
        return F.array_join(F.transform(parts, lambda s, i: F.when(i % 2 == 1, _hide(s)).otherwise(s)), "")

    marked = F.regexp_replace(x, F.lit(f"({ADDRESS})"), F.lit(f"{SEP}$1{SEP}"))  # no unit is parted yet
    return F.when(x.rlike(_ADDRESSED), _let(F.split(marked, SEP), hidden)).otherwise(x)


def _abbreviations(x: Column) -> Column:
    """Points that end no sentence masked. Every pattern starts at a point and looks about from there."""
    alone = r"(?<![\p{L}\p{M}])"
    single = "|".join(sorted(set(ABBREVIATIONS), key=len, reverse=True))
    pairs = "|".join(p.replace(".", r"\.\s?") for p in sorted(set(PAIRS.split())))
    name = r"(?=[\s\u00a0-]*(?:\p{Lu}|d[eiu]\s|del\s|v[ao]n\s|ter\s))"
    ends_none = (
        r"(?<=\d\.)(?=\d)",
        rf"(?<={alone}(?<!\bde\s)\p{{L}}{{1,2}}\.)(?=\s?\p{{L}}{{1,2}}\.)",  # letters with points: all but the last
        rf"(?<={alone}(?:{pairs})\.)",
        rf"(?=[\s({OPEN}-]|\d|$)(?<={alone}(?:{single})\.)",
        rf"(?=\s*\d)(?<={alone}(?:[Nn]o|p|ch|Art|min|max|v|n|п|ст|т)\.)",
        rf"(?<={alone}[พค]\.)(?=ศ\.)|(?<={alone}[พค]\.ศ\.)",
        # initials before a name or a further initial
        rf"{name}(?<=(?<![\p{{L}}\p{{N}}\p{{M}}.])(?<!App\.\s)(?<!\d\s)(?<!\bde\s)\p{{Lu}}\.)",
        rf"(?=\s(?:{ORDINAL})\b)(?<=(?<![\d.,])\d{{1,2}}\.)",
    )
    x = _sub(x, (rf"\.(?:{'|'.join(ends_none)})", DOT))
    x = _sub(x, (rf"\.(?<={DOT}\s?\p{{Lu}}\.)(?=\s\p{{Lu}}\p{{Ll}}+ (?:et al|and|и)\b)", DOT))
    return F.when(F.contains(x, F.lit("...")), F.replace(x, F.lit("..."), F.lit(f"{DOT}{DOT}."))).otherwise(x)


def _if_has(x: Column, signs: str, body) -> Column:  # noqa: ANN001
    """``body`` of a value that holds one of some signs, others as they are."""
    def some(v: Column) -> Column:
        held = reduce(or_, (F.contains(v, F.lit(c)) for c in signs))
        return F.when(held, body(v)).otherwise(v)
    return _let(x, some)


def _quotes(x: Column) -> Column:
    """Quotation marks of all kinds made one opening and one closing sign; what they hold is masked."""
    after = rf"(?=[\s.,;:!?){SEP}]|$)"
    x = _if_has(x, "„", lambda v: _sub(v, ("„", OPEN), (rf"[“”](?<=\S.){after}", CLOSE)))
    x = _if_has(x, "«»", lambda v: _sub(v, (r"»(?<![^\s(].)(?=\S)", OPEN), (rf"«(?<=\S.){after}", CLOSE), ("«", OPEN), ("»", CLOSE)))
    x = _if_has(x, "“”「」『』《》〈〉", lambda v: _sub(v, ("[“「『《〈]", OPEN), ("[”」』》〉]", CLOSE)))
    x = _if_has(x, '"', lambda v: _sub(v, (r"\"(?<![^\s(].)(?=\S)", OPEN), ("\"", CLOSE)))
    told = rf"['‘](?<![^\s(].)(?=\p{{Lu}}[^'’\n]*[.?!,]['’](?:[\s.,;:{SEP}]|$))"
    x = _if_has(x, "'‘’", lambda v: _sub(v, (told, OPEN), (rf"['’](?<=[.?!,].)(?=[\s.,;:{SEP}]|$)", CLOSE)))
    return _enclosed(x, OPEN, CLOSE, TOLD)


def _enclosed(x: Column, opener: str, closer: str, told: str | None = None) -> Column:
    """Terminators between ``opener`` and ``closer`` masked, but for the run right before ``closer``.

    A stretch that goes on over a blank line is unclosed. With ``told``, a closing sign after a terminator
    becomes ``told`` if the stretch was led in by a colon or comma: what was said then ends the sentence around it.
    """
    tail = r"([.!?…؟。！？．।]+\s?)$"

    def stretch(s: Column, i: Column, n: Column) -> Column:
        inner = F.substring_index(s, opener, -1)

        def masked(inner: Column) -> Column:
            head = F.substring(s, F.lit(1), F.length(s) - F.length(inner))
            last = F.regexp_extract(F.right(inner, F.lit(12)), tail, 1)
            body = F.concat(head, _hide(F.left(inner, F.length(inner) - F.length(last))), last)
            close = F.lit(closer)
            if told:
                led = (last != "") & F.right(head, F.lit(3)).rlike(rf"[:：,،，]\s?{opener}$")
                close = F.when(led, F.lit(told)).otherwise(close)
            return F.concat(body, close)

        held = F.contains(s, F.lit(opener)) & ~F.contains(inner, F.lit(SEP))
        return F.when(i == n - 1, s).when(held, _let(inner, masked)).otherwise(F.concat(s, F.lit(closer)))

    def parts(of: Column) -> Column:
        return F.array_join(F.transform(of, lambda s, i: stretch(s, i, F.size(of))), "")

    pattern = closer if closer != ")" else r"\)"
    return _if_has(x, closer, lambda v: _let(F.split(v, pattern), parts))


def _brackets(x: Column) -> Column:
    return _enclosed(_enclosed(x, "(", ")"), "（", "）")


def _lines(x: Column) -> Column:
    """Headings, list items and reference entries on their own lines: one unit each."""
    return _if_has(x, "\n", lambda v: _let(F.split(v, "\n"), _units))


#: Longer lines are headings if numbered or in title case, and items if they end as a sentence does.
SHORT_HEADING, SHORT_ITEM = 48, 60


def _units(raw: Column) -> Column:
    ends = rf"[{_END}。！？．।:;；：{CLOSE}{TOLD})）][ \t\r]*$"
    numbered = r"^(?:\d{1,2}(?:[." + DOT + r"]\d{1,2})*[." + DOT + r"]?\s+)?[\p{Lu}\p{Lo}]"

    def titled(t: Column) -> Column:
        """Whether a line of any length is numbered as headings are, or in title case, and holds no end of a sentence."""
        cased = t.rlike(r"\p{Lu}") & ~t.rlike(r"(?:^|\s)\p{Ll}\S{3}|\p{Lo}")
        number = t.rlike(r"^\d{1,2}(?:[." + DOT + r"]\d{1,2})*[." + DOT + r"]?\s+\p{Lu}")
        return (F.length(t) > SHORT_HEADING) & (cased | number) & ~t.rlike(rf"[{_END}][\s{CLOSE})]")

    def told(s: Column) -> Column:
        """What a line is by itself."""
        t = F.btrim(s, F.lit(" \t\r"))
        return F.struct(
            s.alias("s"), F.length(t).alias("n"), (t == "").alias("blank"), s.rlike(ends).alias("ends"),
            s.rlike(f"^(?:{_LABEL})").alias("label"), s.rlike(rf"{DOT}[ \t\r]*$").alias("short"),
            s.rlike(f"^(?:{_HASH})").alias("hash"), s.rlike(r"^[ \t]*(?:\d|-)").alias("digit"),
            t.rlike(numbered).alias("capital"), t.rlike(rf"[,–—{DOT};-]$").alias("open"), F.endswith(t, F.lit(";")).alias("listed"),
            t.rlike(rf"^(?:{_START}|\p{{Lo}}|[{OPEN}(（\d]|T = )").alias("starts"), titled(t).alias("title"),
        )

    def judged(x: Column) -> Column:
        def unit(v: Column, i: Column) -> Column:
            before, follows = F.get(x, i - 1), F.get(x, i + 1)
            fresh = (i == 0) | before["blank"] | before["ends"]
            item = v["label"] & ~F.coalesce(before["short"], F.lit(False))
            item_before = F.coalesce(before["label"], F.lit(False)) & ~F.coalesce(F.get(x, i - 2)["short"], F.lit(False))
            listed = item & (fresh | item_before | ~v["digit"])
            heading = v["hash"] | (
                (v["n"] > 0) & ((v["n"] <= SHORT_HEADING) | v["title"]) & ~v["ends"] & v["capital"] & fresh
                & F.coalesce(follows["starts"], F.lit(False)) & ~(v["open"] & ~v["listed"]) & ~(item & v["listed"])
            )
            return F.struct(
                v["s"].alias("s"), listed.alias("listed"), heading.alias("heading"),
                ((v["n"] < SHORT_ITEM) | v["ends"]).alias("whole"),
            )

        return F.transform(x, unit)

    def joined(y: Column) -> Column:
        def line(v: Column, i: Column) -> Column:
            before = F.get(y, i - 1)
            unit = v["listed"] | v["heading"]
            new = unit | before["heading"] | (before["listed"] & before["whole"] & ~v["s"].rlike(r"^[ \t]*\p{Ll}"))
            return F.concat(
                F.when(i == 0, F.lit("")).when(new, F.lit(SEP + "\n")).otherwise(F.lit("\n")),
                F.when(unit, _hide(v["s"])).otherwise(v["s"]),
            )

        return F.array_join(F.transform(y, line), "")

    return _let(_let(F.transform(raw, told), judged), joined)


def _thai(x: Column) -> Column:
    """Blanks part sentences where no terminators do, but not beside numbers and foreign names."""
    cuts = (
        (rf"(?<=[\u0e00-\u0e7f])(?=[\s\u00a0]+[\u0e00-\u0e7f])(?![\s\u00a0]+[พค][.{DOT}]ศ)", SEP),
        (r"((?:ในปี|ในหน้า|ในบทที่)[\s\u00a0]\d+)(?=[\s\u00a0]+[\u0e00-\u0e7f])", f"$1{SEP}"),
    )
    return _let(x, lambda v: F.when(v.rlike("[\u0e00-\u0e7f]"), _sub(v, *cuts)).otherwise(v))


def separated(text: Column) -> Column:
    """The text with a separator after each unit; without separators as long as the original."""
    x = F.translate(text, _RESERVED + BLANKS, "\ufffd" * 32 + " " * len(BLANKS))
    x = _let(x, _addresses)
    x = _formulas(x)
    x = _if_has(x, "\n", lambda v: _sub(v, (r"(\r?\n[ \t\r\u00a0]*\n)", f"{SEP}$1")))
    x = _if_has(x, ".", _abbreviations)
    x = _quotes(x)
    x = _brackets(x)
    x = _let(x, _lines)
    closers = rf"(?:\s?[{CLOSE}{TOLD}]|[)\]])*"
    x = _sub(
        x,
        # scripts with case: a terminator, then a blank and a capital
        (rf"([{_END}]+{closers})(?=[\s\u00a0{LINE}]+{_START})", f"$1{SEP}"),
        # a blank forgotten
        (r"([.!?])(?<=(?:\p{Ll}{2}|\d|%|\)).)(?=\p{Lu}\p{Ll}+[\s,])", f"$1{SEP}"),
    )
    caseless = (
        (rf"([{_END}]+(?:\s?{TOLD}|\))*)(?=[\s\u00a0]+[({OPEN}]?\p{{Lo}})", f"$1{SEP}"),
        (rf"([।॥]+\s?{TOLD}?)(?!\s?[{CLOSE}{TOLD}।॥])", f"$1{SEP}"),
        (rf"([。！？．]+(?:{TOLD}|）)*)(?![{CLOSE}{TOLD}）。！？．])(?!と|って)", f"$1{SEP}"),
        (r"([!?]+)(?<=[\u3040-\u30ff\u4e00-\u9fff][!?]{1,9})(?=\p{Lo})", f"$1{SEP}"),
        (rf"(?<=[{_END}]\)|。）)(?=[\s\u00a0]*\p{{Lo}})", SEP),
    )
    plain = F.octet_length(text) == F.length(text)
    return _let(x, lambda v: F.when(plain, v).otherwise(_thai(_sub(v, *caseless))))


#: Units that are added up at a time, so that the sums take time linear in practice.
RUN = 256


def end_positions(text: Column) -> Column:
    """For each unit the position after its last non-blank character; blank units are left out."""
    def size(u: Column) -> Column:
        kept = F.rtrim(u, F.lit(SPACE + LINE))
        return F.struct(F.length(u).cast("bigint").alias("n"), F.length(kept).cast("bigint").alias("k"))

    def runs(sizes: Column) -> Column:
        last = ((F.size(sizes) - 1) / RUN).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda r: F.slice(sizes, r * RUN + 1, F.lit(RUN)))

    none = F.array().cast("array<bigint>")

    def starts(of: Column) -> Column:
        return F.aggregate(
            of,
            F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("all")),
            lambda acc, run: F.struct(
                F.aggregate(run, acc["at"], lambda a, u: a + u["n"]).alias("at"),
                F.concat(acc["all"], F.array(acc["at"])).alias("all"),
            ),
        )["all"]

    def ends(of: Column) -> Column:
        return F.flatten(F.zip_with(of, starts(of), lambda run, start: F.aggregate(
            run,
            F.struct(start.alias("at"), none.alias("all")),
            lambda acc, u: F.struct(
                (acc["at"] + u["n"]).alias("at"),
                F.when(u["k"] > 0, F.concat(acc["all"], F.array(acc["at"] + u["k"]))).otherwise(acc["all"]).alias("all"),
            ),
        )["all"]))

    return _let(_let(F.transform(F.split(separated(text), SEP), size), runs), ends)


def pieces(text: Column, ends: Column) -> Column:
    """The text up to each end, from the one before. Cut in three steps, so that no cut runs through all of a long text."""
    def cut(wholes: Column, size: int) -> Column:
        def parts(w: Column) -> Column:
            last = ((F.size(w["ends"]) - 1) / size).cast("int")

            def part(r: Column) -> Column:
                own = F.slice(w["ends"], r * size + 1, F.lit(size))
                start = F.when(r == 0, w["base"]).otherwise(F.get(w["ends"], r * size - 1))
                piece = F.substring(w["t"], (start - w["base"] + 1).cast("int"), (F.element_at(own, -1) - start).cast("int"))
                return F.struct(piece.alias("t"), own.alias("ends"), start.alias("base"))

            return F.transform(F.sequence(F.lit(0), last), part)

        return F.flatten(F.transform(wholes, parts))

    start = F.array(F.struct(text.alias("t"), ends.alias("ends"), F.lit(0).cast("bigint").alias("base")))
    found = _let(_let(_let(start, lambda w: cut(w, 4096)), lambda w: cut(w, 64)), lambda w: cut(w, 1))
    return F.when(F.size(ends) > 0, F.transform(found, lambda w: F.ltrim(w["t"], F.lit(SPACE)))).otherwise(F.array().cast("array<string>"))


def sentences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per unit: doc_id, pos (from 0), end_pos, sentence (without blanks at its ends)."""
    some = docs.where(F.length(F.btrim(text_col)) > 0)
    ends = some.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), end_positions(F.col(text_col)).alias("ends"))
    both = F.arrays_zip(F.col("ends").alias("end_pos"), pieces(F.col("text"), F.col("ends")).alias("sentence"))
    return ends.select("doc_id", F.posexplode(both).alias("pos", "u")).select("doc_id", "pos", "u.end_pos", "u.sentence")


def boundaries(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The end of every unit: doc_id, end_pos."""
    some = docs.where(F.length(F.btrim(text_col)) > 0)
    return some.select(F.col(id_col).alias("doc_id"), F.explode(end_positions(F.col(text_col))).alias("end_pos"))
