"""Column expressions for text fields, spans and entity names. All of them stay inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns that may hold a document's text, first choice first.
TEXT_FIELDS = ("cleaned_text", "original_text", "text", "content")
#: Entity types that are kept, and spellings of them.
ENTITY_TYPES = ("PER", "ORG", "LOC", "GPE", "DATE", "TIME", "MONEY", "MISC", "EVENT")
TYPE_NAMES = {
    "PERSON": "PER", "ORGANIZATION": "ORG", "LOCATION": "LOC", "GEOPOLITICAL_ENTITY": "GPE", "GEOPOLITICAL": "GPE", "DATE": "DATE", "TIME": "TIME",
    "MONEY": "MONEY", "PERCENT": "MONEY", "CARDINAL": "MISC", "ORDINAL": "MISC", "QUANTITY": "MISC", "MISC": "MISC", "MISCELLANEOUS": "MISC",
}
#: Fixed value: characters of a text that are read.
MAX_TEXT = 1_000_000
#: Fields that are passed on to the output.
PRESERVED_FIELDS = ("document_id", "cleaned_publication_date", "cleaned_source_url")


def present(c: Column) -> Column:
    """The value, with an empty string taken as missing."""
    return F.nullif(c, F.lit(""))


def first_text(*columns: Column) -> Column:
    """The first of the columns that holds any text; null if none does."""
    return F.coalesce(*[present(c) for c in columns])


def preserved(values: dict[str, Column]) -> Column:
    """The fields that have a value, by name; empty strings are values."""
    entries = [x for name, value in values.items() for x in (F.lit(name), value.cast("string"))]
    if not entries:
        return F.lit(None).cast("map<string,string>")
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def input_problem(c: Column, most: int) -> Column:
    """Why a text is refused (blank, too long), or ok; a missing one is blank."""
    return F.when(F.trim(F.coalesce(c, F.lit(""))) == "", "blank").when(F.length(c) > most, "too long").otherwise("ok")


def truncated(c: Column, most: int = MAX_TEXT) -> Column:
    return F.substring(c, 1, most)


def labelled(label: str, value: Column) -> Column:
    return F.when(present(value).isNotNull(), F.concat(F.lit(f"{label}: "), value))


def context_string(title: Column, author: Column, published: Column, summary: Column, categories: Column, tags: Column) -> Column:
    """What is known of a document, a line each; absent parts are left out, tags end after five."""
    listed = lambda a, n: F.when(F.size(F.coalesce(a, F.array())) > 0, F.array_join(F.slice(a, 1, n), ", "))
    return F.concat_ws(
        "\n",
        labelled("Title", title), labelled("Author", author), labelled("Published", published), labelled("Summary", summary),
        labelled("Categories", listed(categories, 1_000_000)), labelled("Tags", listed(tags, 5)),
    )


def normalised_date(c: Column) -> Column:
    """ISO date and time: kept if it has a T, reformatted if it can be read, else left as it is."""
    read = F.coalesce(F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")), F.try_to_timestamp(c, F.lit("yyyy-MM-dd")))
    return F.when(F.contains(c, F.lit("T")), c).otherwise(F.coalesce(F.date_format(read, "yyyy-MM-dd'T'HH:mm:ss"), c))


def entity_type(c: Column) -> Column:
    """An entity type without B- and I- marks, in its usual spelling; unknown ones in capitals."""
    bare = F.upper(F.replace(F.replace(c, F.lit("B-"), F.lit("")), F.lit("I-"), F.lit("")))
    names = F.create_map(*[F.lit(x) for pair in TYPE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, bare), bare)


def context_window(text: Column, start: Column, end: Column, width: int = 50) -> Column:
    """The text around a span, the span itself in brackets, white space collapsed."""
    left = F.greatest(F.lit(0), start - width)
    right = F.least(F.length(text), end + width)
    part = lambda a, b: F.substring(text, (a + 1).cast("int"), F.greatest(F.lit(0), b - a).cast("int"))
    joined = F.concat(part(left, start), F.lit("["), part(start, end), F.lit("]"), part(end, right))
    return F.trim(F.regexp_replace(joined, r"\s+", " "))


def span_valid(start: Column, end: Column, length: Column) -> Column:
    return (start >= 0) & (end >= 0) & (start < end) & (end <= length)


def normalised_name(c: Column) -> Column:
    return F.regexp_replace(F.trim(F.lower(c)), r"\s+", " ")


def name_tokens(c: Column) -> Column:
    """The different words of a name; full stops and commas part words, apostrophes vanish."""
    cleaned = F.lower(F.translate(c, ".,'", "  "))
    return F.array_distinct(F.filter(F.split(cleaned, r"\s+"), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays; 0 if either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def substring_match(a: Column, b: Column) -> Column:
    return F.contains(a, b) | F.contains(b, a)


def size_in_bytes(c: Column) -> Column:
    """"100MB" and the like as bytes; 100 MB where it can't be read."""
    number = F.regexp_extract(F.upper(F.trim(c)), r"^(\d+(?:\.\d+)?)\s*(B|KB|MB|GB|TB)$", 1)
    unit = F.regexp_extract(F.upper(F.trim(c)), r"^(\d+(?:\.\d+)?)\s*(B|KB|MB|GB|TB)$", 2)
    factor = reduce(lambda acc, u: acc.when(unit == u[1], F.lit(float(1024 ** u[0]))), enumerate(("B", "KB", "MB", "GB", "TB")), F.when(F.lit(False), F.lit(1.0)))
    return F.coalesce((F.nullif(number, F.lit("")).cast("double") * factor).cast("long"), F.lit(100 * 1024 * 1024).cast("long"))


def routing_key(kind: Column) -> Column:
    """The last two dot-separated parts of a message type."""
    parts = F.split(kind, r"\.")
    return F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), F.lit(2)), ".")


def tokens(text: Column) -> Column:
    """Split at single spaces, so that joining gives the text back."""
    return F.split(text, " ", -1)


def chunks(words: Column, size: int = 2048, overlap: int = 256) -> Column:
    """Windows of ``size`` tokens that share ``overlap`` with the next; a text that fits is one window."""
    step = size - overlap
    more = F.ceil(F.greatest(F.size(words) - size, F.lit(0)) / step).cast("int")
    return F.transform(F.sequence(F.lit(0), more), lambda i: F.struct((i * step).alias("first"), F.slice(words, i * step + 1, F.lit(size)).alias("words")))
