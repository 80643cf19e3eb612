"""Scalar functions over annotation text: functions, comments, roles, ids, aliases and small formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMMENT = r"^(.*?)(?:\s+(#+)\s+(.*))?$"
_HASH = r"\s*#.*$"


def split_comment(text: Column) -> Column:
    """(func, sep, comment) of `function # comment`; sep and comment are empty without one."""
    return F.struct(*(F.regexp_extract(text, _COMMENT, i + 1).alias(n) for i, n in enumerate(("func", "sep", "comment"))))


def is_truncated(text: Column) -> Column:
    """Annotated as a fragment: the sign is exactly one # and the comment starts so."""
    c = split_comment(text)
    return (c["sep"] == "#") & c["comment"].rlike("^(frag|missing|trunc)")


def strip_comment(text: Column) -> Column:
    """The function without its comment: all from the first # on, and the blanks before it."""
    return F.regexp_replace(text, _HASH, "")


def strip_function(text: Column) -> Column:
    """The function without comment and without a leading FIG number."""
    return F.regexp_replace(text, _HASH + r"|^FIG\d{6}[^:]*:\s*", "")


def split_roles(function: Column) -> Column:
    """The parts of a function without comment, at ` / `, ` @ ` or `; `; nothing after the last mark is no part, and the empty text has none."""
    parts = F.split(function, r"\s+[/@]\s+|\s*;\s+")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def roles(text: Column) -> Column:
    """The roles of a multi-role function; a comment, from its first # on, is none."""
    return split_roles(strip_comment(text))


def is_hypothetical(function: Column) -> Column:
    """A function without content: the plain hypothetical one, or one that was named by a core cluster's id."""
    return (function == "hypothetical protein") | function.contains("core_cid")


def fusion_parts(text: Column) -> Column:
    return F.split(text, " / ")


def definition(text: Column) -> Column:
    """(function, genome) of a definition line `function [genome name]`; nulls if it has another form."""
    form = r"^\s*(.*)\s+\[([^\]]+)\]$"
    ok = text.rlike(form)
    return F.struct(F.when(ok, F.regexp_extract(text, form, 1)).alias("function"), F.when(ok, F.regexp_extract(text, form, 2)).alias("genome"))


def genome_of(fid: Column) -> Column:
    """The genome number in a feature id `fig|genome.peg.n`; null for other ids."""
    return F.nullif(F.regexp_extract(fid, r"fig\|(\d+\.\d+)", 1), F.lit(""))


def natural_key(fid: Column) -> Column:
    """Sort key of feature ids `fig|taxon.version.type.n`: numbers by value; other ids come first, by text."""
    form = r"^fig\|(\d+)\.(\d+)\.([^.]+)\.(\d+)$"
    part = lambda i: F.nullif(F.regexp_extract(fid, form, i), F.lit(""))
    return F.struct(part(1).cast("long").alias("taxon"), part(2).cast("long").alias("version"), part(3).alias("type"), part(4).cast("long").alias("n"), fid.alias("fid"))


def nr_id(text: Column) -> Column:
    """A database id cut at Ctrl-A; of a gi id only its first two fields stay."""
    cut = F.regexp_extract(text, "^([^\\x01]*)", 1)
    return F.when(cut.rlike(r"^gi\|\d+"), F.regexp_extract(cut, r"^(gi\|\d+)", 1)).otherwise(cut)


def escape_id(text: Column) -> Column:
    """Blank, comma and colon escaped, as composite ids have them."""
    return F.replace(F.replace(F.replace(text, F.lit(" "), F.lit("%20")), F.lit(","), F.lit("%2C")), F.lit(":"), F.lit("%3A"))


def unescape_id(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("%20"), F.lit(" ")), F.lit("%2C"), F.lit(",")), F.lit("%3A"), F.lit(":"))


def minutes(text: Column) -> Column:
    """Minutes of an elapsed time HH:MM:SS (days- in front allowed)."""
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(text, r"^(?:(\d+)-)?(\d+):(\d+):(\d+)$", i), F.lit("")).cast("double"), F.lit(0.0))
    return F.when(text.rlike(r"^(?:\d+-)?\d+:\d+:\d+$"), part(1) * 1440 + part(2) * 60 + part(3) + part(4) / 60)


def family_id(number: Column, prefix: str, digits: int = 8) -> Column:
    return F.concat(F.lit(prefix), F.lpad(number.cast("string"), digits, "0"))


def clamp_byte(x: Column) -> Column:
    """30 times a weight, held to 0..255 and cut to a whole number."""
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), x * 30)).cast("int")


def names_of(aliases: Column) -> Column:
    """(gene, alias) of comma-parted aliases, read up to the first locus tag (`locus|` or `LocusTag:`).

    gene: the last name of four letters; alias: the locus tag, or without one the last name without a prefix. Null if there is none.
    """
    each = F.split(aliases, ",")
    mark = r"^(locus\||LocusTag:)"
    at = F.array_position(F.transform(each, lambda a: a.rlike(mark)), True)
    read = F.when(at > 0, F.slice(each, F.lit(1), (at - 1).cast("int"))).otherwise(each)
    gene = F.try_element_at(F.filter(read, lambda a: a.rlike("^[A-Za-z]{4}$")), F.lit(-1))
    plain = F.try_element_at(F.filter(read, lambda a: ~a.rlike("[:|]")), F.lit(-1))
    tag = F.regexp_replace(F.try_element_at(each, at.cast("int")), mark, "")
    return F.struct(gene.alias("gene"), F.when(at > 0, tag).otherwise(plain).alias("alias"))


def attributes(text: Column) -> Column:
    """key=value;key=value as a map."""
    return F.str_to_map(text, F.lit(";"), F.lit("="))


def recall_class(old: Column, new: Column) -> Column:
    """unchanged, added (was hypothetical), lost (is hypothetical now) or changed; an empty new function is hypothetical."""
    hypo = F.lit("hypothetical protein")
    now = F.when(new.isNull() | (new == ""), hypo).otherwise(new)
    return F.when(old == now, "unchanged").when(old == hypo, "added").when(now == hypo, "lost").otherwise("changed")


def cache_path(base: str, genome: Column) -> Column:
    """Folder of a genome's cache: sharded by the last three digits of its taxon."""
    taxon = F.regexp_extract(genome, r"^(\d+)", 1)
    return F.concat_ws("/", F.lit(base), F.right(F.lpad(taxon, 3, "0"), F.lit(3)), genome)


def hit_line(*fields: Column) -> Column:
    return F.concat_ws("\t", *(f.cast("string") for f in fields))
