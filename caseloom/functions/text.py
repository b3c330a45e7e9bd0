"""Column expressions over text: strip, cleaning, validity, quality measures, document types. No Python runs on executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that stand for no entity, and phrases whose repetition marks invented text.
PLACEHOLDER_NAMES = ("full name as written", "organization name", "organization name (unknown)", "user", "unknown", "n/a", "none", "")
LOOP_PHRASES = ("object\nobject\nobject", "Do not change the text", "a blue bottle, a white bottle", "\\n\\n\\n\\n\\n")


def strip(c: Column) -> Column:
    """All white space off both ends, not only spaces."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def pipe_clean(c: Column) -> Column:
    """What stands before the first pipe, stripped."""
    return strip(F.split_part(c, F.lit("|"), F.lit(1)))


def valid_name(c: Column, id_pattern: str = r"(?i)^[A-Z]{4}\d+$", stop: tuple[str, ...] = PLACEHOLDER_NAMES) -> Column:
    """False for blanks, placeholders, document ids and echoed instructions."""
    low = F.lower(strip(F.coalesce(c, F.lit(""))))
    return ~(low.isin(*stop) | low.rlike(id_pattern) | low.contains("exact quote") | low.contains("one sentence"))


def safe_props(m: Column) -> Column:
    """Map values stripped and pipe-cleaned; blank ones dropped."""
    return F.map_filter(F.transform_values(m, lambda _, v: pipe_clean(v)), lambda _, v: v.isNotNull() & (v != ""))


def safe_list(c: Column) -> Column:
    """A list property: its strings stripped, blank ones dropped; null where none is left."""
    kept = F.filter(F.transform(c, strip), lambda x: x.isNotNull() & (x != ""))
    return F.when(F.size(kept) > 0, kept)


def safe_struct(record: Column, fields: dict[str, str]) -> Column:
    """Properties of mixed types (name: 'string', 'list' or 'other'): strings and lists cleaned, others as they are; absent where null."""
    clean = {"string": lambda c: F.nullif(pipe_clean(c), F.lit("")), "list": safe_list, "other": lambda c: c}
    return F.struct(*[clean[kind](record[name]).alias(name) for name, kind in fields.items()])


def words(c: Column) -> Column:
    return F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda w: w != "")


def sampled_windows(c: Column, window: int = 10) -> Column:
    """About 100 windows of a text, one every hundredth of it; null below 20 characters.

    One pass of a pattern that looks at a window and moves on by a step: ``substring`` would read the text
    from its start for each.
    """
    n = F.length(c)
    step = F.greatest(F.lit(1), (n / 100).cast("int"))
    return F.when(n >= 20, F.regexp_extract_all(c, F.format_string(f"(?s)(?=(.{{{window}}}).).{{1,%d}}", step), F.lit(1)))


def repeated_share(parts: Column) -> Column:
    """Share of the elements that occurred before; 0 for null. Give a column, not an expression: it is read three times."""
    return F.when(parts.isNull() | (F.size(parts) == 0), 0.0).otherwise((F.size(parts) - F.size(F.array_distinct(parts))) / F.size(parts))


def distinct_share(w: Column, least: int = 10) -> Column:
    """Share of distinct words; 0 below ``least`` words. Give a column, not an expression."""
    return F.when(F.size(w) < least, 0.0).otherwise(F.size(F.array_distinct(w)) / F.size(w))


def repetition_ratio(c: Column, window: int = 10) -> Column:
    """Share of sampled windows that occurred before, in one expression; for whole tables make the windows a column first."""
    return repeated_share(sampled_windows(c, window))


def unique_word_ratio(c: Column) -> Column:
    return distinct_share(words(c))


def number_sequence(c: Column) -> Column:
    rest = F.translate(c, " .\n", "")
    return (F.length(rest) > 0) & ((F.length(rest) - F.length(F.regexp_replace(rest, r"\p{Nd}+", ""))) / F.length(rest) > 0.8)


def occurrences(c: Column, phrase: str) -> Column:
    """How often the phrase occurs, not overlapping."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(phrase), F.lit("")))) / len(phrase)).cast("int")


def classify(pages: Column) -> Column:
    """Type of a document by the text of its first pages: the sample stops growing beyond 200 characters."""
    head = F.slice(pages, 1, 3)
    sample = F.aggregate(head, F.lit(""), lambda a, p: F.when(F.length(a) > 200, a).otherwise(F.concat(a, F.coalesce(p, F.lit("")))))
    n, one = F.length(strip(sample)), F.size(pages) == 1
    return F.when(n > 200, "text_document").when((n == 0) & one, "photograph").when((n > 0) & one, "mixed").otherwise("unknown")


def triage(text: Column, has_fonts: Column) -> Column:
    n = F.length(strip(F.coalesce(text, F.lit(""))))
    return F.when(has_fonts & (n > 200), "text").when(has_fonts & (n > 50), "text_weak").otherwise("image")


def text_fingerprint(c: Column) -> Column:
    """md5 of the lines longer than 10 characters; null where nothing is left."""
    kept = F.array_join(F.filter(F.split(c, "\n"), lambda x: F.length(strip(x)) > 10), " ")
    return F.when(strip(kept) != "", F.md5(kept))


def group_id(hashes: Column) -> Column:
    """Eight hex digits of the md5 of the sorted 16-digit prefixes, written as a JSON list."""
    first = F.transform(F.array_sort(hashes), lambda h: F.substring(h, 1, 16))
    return F.substring(F.md5(F.concat(F.lit('["'), F.array_join(first, '", "'), F.lit('"]'))), 1, 8)


def fenced_json(c: Column) -> Column:
    """The body of the first fenced block, else the whole text; a missing closing fence reads to the end."""
    body = F.regexp_extract(c, r"(?s)```(?:json)?\s*\n?(.*?)(?:```|\z)", 1)
    return F.when(c.contains("```"), strip(body)).otherwise(strip(c))


def marker_confidence(text: Column) -> Column:
    """By length: below 20 characters stripped, below 100 as they are."""
    raw = F.coalesce(text, F.lit(""))
    return F.when(raw == "", 0.0).when(F.length(strip(raw)) < 20, 0.2).when(F.length(raw) < 100, 0.4).otherwise(0.8)


def vision_first_confidence(text: Column) -> Column:
    n = F.length(strip(F.coalesce(text, F.lit(""))))
    return F.when(n > 200, 0.8).when(n > 50, 0.5).otherwise(0.2)


def accepted(text: Column, confidence: Column, legacy: bool = False) -> Column:
    """Whether a text reader's result is taken: by confidence, in the legacy order by length too."""
    sure = confidence > 0.6
    return sure & (F.length(strip(F.coalesce(text, F.lit("")))) > 100) if legacy else sure


def vision_confidence(text: Column, track: Column, stripped: bool = False) -> Column:
    """0.85 for a photograph; a text read from images is sure from 51 characters on, counted raw or stripped."""
    t = F.coalesce(text, F.lit(""))
    return F.when(track == "photograph", 0.85).when(F.length(strip(t) if stripped else t) > 50, 0.9).otherwise(0.7)


#: Fixed value: what stands between a text and the analysis of its image.
VISUAL = "\n\n--- VISUAL ANALYSIS ---\n\n"


def mixed_text(text: Column, analysis: Column) -> Column:
    return F.concat(F.coalesce(text, F.lit("")), F.lit(VISUAL), F.coalesce(analysis, F.lit("")))


def longer_text(first: Column, second: Column, shortest: int = 100) -> Column:
    """``first``, unless it is shorter than ``shortest`` stripped and ``second`` is longer."""
    n = lambda c: F.length(strip(F.coalesce(c, F.lit(""))))
    return F.when((n(first) < shortest) & (n(second) > n(first)), second).otherwise(first)


def cosine(a: Column, b: Column) -> Column:
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    return dot / (norm(a) * norm(b))


def bit_similarity(a: Column, b: Column) -> Column:
    """Share of equal bits of two strings of 0 and 1; 0 where lengths differ."""
    same = F.aggregate(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return F.when(F.length(a) != F.length(b), 0.0).when(F.length(a) == 0, 0.0).otherwise(same / F.length(a))


def balanced_json(c: Column) -> Column:
    """From the first opening brace to its balanced closing one, braces in strings counted too; else the text as it is."""
    start = F.locate("{", c)
    tail = F.substring(c, start, F.length(c))
    parts = F.split(tail, r"\}")
    closed = F.slice(parts, F.lit(1), F.size(parts) - 1)
    opened = lambda p: F.length(p) - F.length(F.replace(p, F.lit("{"), F.lit("")))

    def step(s: Column, p: Column) -> Column:
        depth, read = s["depth"] + opened(p) - 1, s["read"] + F.length(p) + 1
        return F.struct(depth.alias("depth"), read.alias("read"), F.when((s["end"] == 0) & (depth == 0), read).otherwise(s["end"]).alias("end"))

    zero = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("read"), F.lit(0).alias("end"))
    end = F.aggregate(closed, zero, step)["end"]
    return F.when((start > 0) & (end > 0), F.substring(tail, F.lit(1), end)).otherwise(c)


def rewrite_outcome(original: Column, corrected: Column) -> Column:
    """Whether a proposed rewrite is an error, keeps the original or replaces it; one under half the length counts as partial."""
    short = F.length(corrected) < F.length(F.coalesce(original, F.lit(""))) * 0.5
    return F.when(corrected.isNull(), "error").when(F.lower(corrected).contains("no corrections needed"), "kept").when(short, "error").otherwise("rewritten")


def accepted_rewrite(original: Column, corrected: Column) -> Column:
    """The text after a rewrite: the proposal without its code fences where it is accepted, else the original."""
    bare = strip(F.regexp_replace(strip(corrected), r"^```(?:markdown)?|```$", ""))
    return F.when(rewrite_outcome(original, corrected) == "rewritten", bare).otherwise(original)


def prompt_template(document_type: Column, has_redactions: Column) -> Column:
    """Id of the prompt for a document: photographs first, then redactions, then the type; tables and forms add a suffix."""
    base = F.when(F.coalesce(has_redactions, F.lit(False)), "redaction_aware").when(document_type.isin("identity_document", "legal_document"), document_type).otherwise("general")
    suffix = F.when(document_type.isin("table", "form"), F.concat(F.lit("+"), document_type)).otherwise("")
    return F.when(document_type == "photograph", "photograph").otherwise(F.concat(base, suffix))


def block_kind(c: Column) -> Column:
    """A block type without its enumeration's name."""
    return F.when(c.contains("BlockTypes."), F.element_at(F.split(c, r"\."), -1)).otherwise(c)


def block_prompt(text: Column, block_type: Column, instructions: dict[str, str], template: str = "%s\n\n%s") -> Column:
    """The template filled with the block type's instruction, blank where it has none, and the text."""
    known = F.create_map(*[F.lit(x) for pair in instructions.items() for x in pair]) if instructions else F.create_map().cast("map<string,string>")
    return F.format_string(template, F.coalesce(F.try_element_at(known, block_kind(block_type)), F.lit("")), F.coalesce(text, F.lit("")))


def mean_hash(pixels: Column, size: int | None = 32 * 32) -> Column:
    """One bit per grey value, 1 where it is above their mean; an image that is null or of another size gives ''."""
    n = F.size(pixels)
    mean = F.aggregate(pixels, F.lit(0.0), lambda s, x: s + x) / n
    bits = F.array_join(F.transform(pixels, lambda x: F.when(x > mean, "1").otherwise("0")), "")
    fits = pixels.isNotNull() & (n > 0) if size is None else pixels.isNotNull() & (n == size)
    return F.when(fits, bits).otherwise("")
