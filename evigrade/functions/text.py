"""Column functions on text."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from evigrade.functions import vocab


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value made once for a row.

    A plain column is an expression that is made wherever it is named, also where a struct's fields are read.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(c: Column | str) -> Column:
    """Without white space of any kind at the ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def filled(c: Column | str) -> Column:
    """Null as empty text."""
    return F.coalesce(col(c), F.lit(""))


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(strip(c), F.lit(""))


def truncate_marked(c: Column | str, most: int) -> Column:
    """The first characters, and how many more there were."""
    c = filled(c)
    left = F.format_string("\n…[truncated, %d more chars]", (F.length(c) - most).cast("int"))
    return F.when(F.length(c) > most, F.concat(F.left(c, F.lit(most)), left)).otherwise(c)


def clean_markdown(c: Column | str) -> Column:
    """Without images, links as their text, no long gaps."""
    c = F.regexp_replace(filled(c), r"!\[[^\]]*\]\([^)]+\)", "")
    c = F.regexp_replace(c, r"\[([^\]]*)\]\([^)]+\)", "$1")
    c = F.regexp_replace(c, r"\n{3,}", "\n\n")
    return strip(F.regexp_replace(c, r"[ \t]{3,}", " "))


def markdown_cell(c: Column | str, most: int = 260) -> Column:
    """One line for a table cell."""
    c = F.replace(strip(F.regexp_replace(filled(c), r"\s+", " ")), F.lit("|"), F.lit("\\|"))
    short = F.concat(F.regexp_replace(F.left(c, F.lit(most - 1)), r"\s+$", ""), F.lit("…"))
    return F.when(F.length(c) > most, short).otherwise(c)


def digits_only(c: Column | str) -> Column:
    return F.regexp_replace(filled(c), "[^0-9]", "")


def normal_name(c: Column | str) -> Column:
    """Lower-case letters and digits of any script."""
    return F.regexp_replace(F.lower(filled(c)), r"[^\p{L}\p{N}]", "")


def _pieces(c: Column | str) -> Column:
    return F.filter(F.split(F.lower(filled(c)), "[^a-z0-9]+"), lambda t: F.length(t) >= 3)


def _is_number(t: Column) -> Column:
    return t.rlike("^[0-9]+$")


def capture_tokens(c: Column | str) -> Column:
    """Lower-case ASCII words of three or more characters, repeats kept."""
    return _pieces(c)


def business_tokens(c: Column | str) -> Column:
    """Distinct words in order, without stop words and numbers below four digits."""
    kept = F.filter(
        _pieces(c), lambda t: ~t.isin(*vocab.BUSINESS_STOPWORDS) & ~(_is_number(t) & (F.length(t) < 4))
    )
    return F.array_distinct(kept)


def match_tokens(c: Column | str) -> Column:
    return F.array_distinct(F.filter(_pieces(c), lambda t: ~t.isin(*vocab.MATCH_STOPWORDS)))


def match_score(a: Column | str, b: Column | str) -> Column:
    """Share of a's words that b has, to three places, half to even."""
    left, right = match_tokens(a), match_tokens(b)
    share = F.bround(F.try_divide(F.size(F.array_intersect(left, right)), F.size(left)), 3)
    return F.when((F.size(left) > 0) & (F.size(right) > 0), share).otherwise(F.lit(0.0))


#: What is longer is looked up in a page's whole text.
REACH = 64


def distinct_pieces(c: Column | str) -> Column:
    """The pieces of a text between spaces and slashes, each once.

    What has neither of these characters stands in the pieces if and only if it stands in the text; a page that says
    the same again and again has few.
    """
    once = lambda t, mark: F.array_join(F.array_distinct(F.split(t, mark)), mark)
    return once(once(col(c), " "), "/")


def _beyond_pieces(ean: Column | str) -> Column:
    """Whether an EAN can't be looked up in pieces: it may stand across them."""
    return filled(ean).rlike(r"[ /\n]") | (F.octet_length(filled(ean)) > REACH)


def needs_text(hint: Column | str, ean: Column | str) -> Column:
    """Whether hint_score() reads a page's whole text and not only its pieces."""
    return _beyond_pieces(ean) | F.lower(filled(hint)).rlike(f"[a-z0-9]{{{REACH + 1},}}")


def hint_score(text: Column, hint: Column | str, ean: Column | str, pieces: Column | None = None) -> Column:
    """20 for the EAN, 3 for each of the hint's first words in the text, 18 at most.

    pieces: the distinct_pieces() of the text, or of one in which all that has no line end and REACH bytes at most stands as in the text.
    """
    words = F.array_distinct(F.slice(F.filter(capture_tokens(hint), lambda t: ~_is_number(t)), 1, 24))
    ean_in = lambda where: F.contains(where, filled(ean))
    if pieces is None:
        found, stands = ean_in(text), lambda t: F.contains(text, t)
    else:
        found = F.when(_beyond_pieces(ean), ean_in(text)).otherwise(ean_in(pieces))
        stands = lambda t: F.when(F.length(t) > REACH, F.contains(text, t)).otherwise(F.contains(pieces, t))
    hits = F.size(F.filter(words, stands))
    found = (filled(ean) != "") & found
    return F.when(found, 20).otherwise(0) + F.least(F.lit(18), 3 * hits)


def count_terms(text: Column, terms: Iterable[str], pieces: Column | None = None) -> Column:
    """How many of the terms occur anywhere in the text.

    pieces: the text's distinct_pieces(), where words are looked up; the text itself is read only for terms of several words which
    all stand there.  Terms have no slash.
    """
    total = F.lit(0)
    for term in terms:
        found = F.contains(text if pieces is None else pieces, F.lit(term))
        if pieces is not None and " " in term:
            found = F.lit(True)
            for word in term.split(" "):
                found = found & F.contains(pieces, F.lit(word))
            found = F.when(found, F.contains(text, F.lit(term))).otherwise(False)
        total = total + found.cast("int")
    return total


def any_term(text: Column, terms: Iterable[str]) -> Column:
    found = F.lit(False)
    for term in terms:
        found = found | F.contains(text, F.lit(term))
    return found


def terms_in(text: Column, terms: Iterable[str]) -> Column:
    """The terms that occur, sorted."""
    marks = F.array(*[F.when(F.contains(text, F.lit(t)), F.lit(t)) for t in sorted(terms)])
    return F.filter(marks, lambda t: t.isNotNull())


def listed(*pairs: tuple[Column, Column | str]) -> Column:
    """An array of the values whose conditions hold, in order, without repeats."""
    marks = [F.when(condition, F.lit(v) if isinstance(v, str) else v) for condition, v in pairs]
    return F.array_distinct(F.filter(F.array(*marks), lambda v: v.isNotNull()))


def split_snippets(c: Column | str) -> Column:
    """A JSON array of texts, or texts split at line ends and double bars; empty ones go."""
    c = strip(filled(c))
    parsed = F.when(c.startswith("["), F.from_json(c, "array<string>"))
    plain = F.split(c, r"\n+|\|\|")
    return F.filter(F.transform(F.coalesce(parsed, plain), strip), lambda s: s != "")


def tri_state(c: Column | str) -> Column:
    """True, false, or null for anything else."""
    c = F.lower(strip(filled(c)))
    return F.when(c.isin(*vocab.TRUE_WORDS), True).when(c.isin(*vocab.FALSE_WORDS), False)


def is_true(c: Column | str) -> Column:
    return F.lower(strip(filled(c))).isin(*vocab.TRUE_WORDS)


def int_or(c: Column | str, default: int) -> Column:
    """The whole part of a number, or the default for anything else, NaN and infinities too."""
    number = strip(filled(c)).try_cast("double")
    sound = number.isNotNull() & ~F.isnan(number) & (F.abs(number) < 2147483648.0)
    return F.when(sound, F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number)).cast("int")).otherwise(default)


def stable_id(c: Column | str, row_number: Column | str) -> Column:
    """A file-safe id from an input id, or from the row number."""
    default = F.format_string("row_%06d", col(row_number).cast("int"))
    raw = F.coalesce(F.nullif(filled(c), F.lit("")), default)
    safe = F.regexp_replace(F.regexp_replace(strip(raw), "[^A-Za-z0-9._-]+", "-"), "^[-._]+|[-._]+$", "")
    return F.coalesce(F.nullif(safe, F.lit("")), default)


def vision_verdict(c: Column | str) -> Column:
    """yes, no or empty from a description's first line."""
    return F.lower(F.regexp_extract(filled(c), r"(?i)^\s*RELATED\s*:\s*(yes|no)\b", 1))


#: Keys of an object under which its text may stand, in order.
_PAYLOAD_KEYS = (
    "raw_markdown", "fit_markdown", "markdown", "markdown_with_citations", "text", "content", "cleaned_html", "html", "body",
)


def payload_text(value: Column, depth: int = 3) -> Column:
    """The text of a payload given as a variant: a scalar, the first of an object's known keys, or an array's texts by line."""
    kind = F.schema_of_variant(value)
    scalar = F.try_variant_get(value, "$", "string")
    if not depth:
        return F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), "").otherwise(filled(scalar))
    under = F.array(*[F.try_variant_get(value, f"$.{k}", "variant") for k in _PAYLOAD_KEYS])
    inner = F.filter(F.transform(under, lambda v: payload_text(v, depth - 1)), lambda t: t != "")
    items = F.try_variant_get(value, "$", "array<string>")
    lines = F.array_join(F.filter(items, lambda t: filled(t) != ""), "\n")
    whole = F.when(kind.startswith("OBJECT"), F.coalesce(F.get(inner, F.lit(0)), F.lit(""))).when(kind.startswith("ARRAY"), filled(lines))
    return F.when(value.isNull(), "").otherwise(whole.otherwise(filled(scalar)))


def strip_json_fence(c: Column | str) -> Column:
    """A reply without its code fence; of a reply that begins with prose, from the first to the last brace."""
    c = strip(filled(c))
    bare = strip(F.regexp_replace(strip(F.regexp_replace(c, r"(?i)^```(?:json)?\s*", "")), r"\s*```$", ""))
    text = F.when(c.startswith("```"), bare).otherwise(c)
    inner = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    return F.when(text.startswith("{") | text.startswith("[") | (inner == ""), text).otherwise(inner)


def json_reply(c: Column | str) -> Column:
    """The JSON object of a reply as a variant; null for anything else."""
    value = F.try_parse_json(strip_json_fence(c))
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), value)


def prepend_once(c: Column | str, marker: str, section: Column | str) -> Column:
    """A section before a text, unless its marker is in the text."""
    c, section = filled(c), F.lit(section) if isinstance(section, str) else section
    return F.when(F.contains(c, F.lit(marker)), c).otherwise(F.concat(section, F.lit("\n"), c))


def axes_cell(axes: Column | str) -> Column:
    return F.array_join(F.filter(col(axes), lambda a: filled(a) != ""), ",")


def refs_cell(refs: Column | str) -> Column:
    """The first four references in one cell."""
    return markdown_cell(F.array_join(F.slice(col(refs), 1, 4), "; "), 360)


def numbered_verdicts(c: Column | str, n: Column | int) -> Column:
    """An array of n verdicts from lines like "2: yes"; others are empty, the last line of a number counts."""
    n = F.lit(n) if isinstance(n, int) else n
    lines = F.transform(F.split(filled(c), r"\r\n|[\n\r]"), lambda s: strip(F.regexp_replace(strip(s), r"^[-*•]+", "")))
    pattern = r"(?i)^\(?([0-9]+)[).:]\s*(yes|no)\b"
    found = F.transform(
        F.filter(lines, lambda s: s.rlike(pattern)),
        lambda s: F.struct(F.regexp_extract(s, pattern, 1).cast("int").alias("i"), F.lower(F.regexp_extract(s, pattern, 2)).alias("v")),
    )
    return F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.coalesce(F.get(F.reverse(F.filter(found, lambda f: f["i"] == i)), F.lit(0))["v"], F.lit("")),
    )
