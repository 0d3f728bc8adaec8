"""Text as Column functions: normalisation, sentences, speaker ids, labels, paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentence ends, letters that are capitalised after them, speaker label.
SENTENCE_END = ".?!"
CAPITALISED = "a-zæøåäöü"
SPEAKER_LABEL = "Speaker "
#: Never part of a text: marks the places where a text is cut.
CUT = "\x01"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(col(c), r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+\z", "")


def capitalise(c: Column) -> Column:
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))


def normalize_text(c) -> Column:
    """Stripped; the first letter and each lower-case one after a sentence end and white space in upper case, that space made one blank."""
    marked = F.regexp_replace(strip(c), rf"(?U)([{SENTENCE_END}])\s+([{CAPITALISED}])", f"$1{CUT}$2")
    return F.array_join(F.transform(F.split(marked, CUT), capitalise), " ")


def sentences(c) -> Column:
    """Parts of a text after each sentence end that white space follows."""
    return F.split(col(c), rf"(?U)(?<=[{SENTENCE_END}])\s+")


def ends_sentence(c) -> Column:
    """Whether the last character before trailing white space ends a sentence."""
    return col(c).rlike(rf"(?U)[{SENTENCE_END}]\s*\z")


def canonical_speaker(c) -> Column:
    """The speaker without the ``chunk_<digits>_`` that tells its chunk."""
    return F.regexp_replace(strip(c), r"^chunk_[0-9]+_", "")


def speaker_prefix(c) -> Column:
    """``<id>: ``, or nothing for a blank id."""
    own = strip(c)
    return F.when(own == "", "").otherwise(F.concat(own, F.lit(": ")))


def item_text(text, speaker, default: str = "Speaker 0: ") -> Column:
    """A text that already names its speaker stays; others get the speaker's prefix, or else the default one."""
    own, prefix = strip(text), F.coalesce(speaker_prefix(speaker), F.lit(""))
    return strip(F.when(own.startswith(SPEAKER_LABEL), own).when(prefix != "", F.concat(prefix, own)).otherwise(F.concat(F.lit(default), own)))


def base_name(c) -> Column:
    """What follows the last slash."""
    return F.element_at(F.split(col(c), "/"), -1)


def stem(c) -> Column:
    """The base name without its last extension; a leading dot isn't one."""
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]*$", "")


def suffix(c) -> Column:
    """The last extension with its dot, in lower case; empty without one."""
    return F.lower(F.regexp_extract(base_name(c), r".(\.[^.]*)$", 1))


def file_name(path, kind: str, item, position=None) -> Column:
    """A path's base name, or a numbered name where there is none."""
    own = F.when((base_name(path) != "") & (base_name(path) != "."), base_name(path))
    made = F.format_string(f"{kind}_%06d_%03d.wav", col(item), col(position)) if position is not None else F.format_string(f"{kind}_%06d.wav", col(item))
    return F.coalesce(own, made)


def display_name(paths) -> Column:
    """Names of datasets joined by underscores: a local one by its last folder, another with its slash replaced."""
    return F.array_join(F.transform(col(paths), lambda p: F.when(p.startswith("/") | p.startswith("."), base_name(F.regexp_replace(p, "/+$", ""))).otherwise(F.replace(p, F.lit("/"), F.lit("_")))), "_")


def clip_name(file, index, speaker) -> Column:
    return F.format_string("%s_utt_%05d__spk__%s.wav", col(file), col(index), col(speaker))


def utterance_index(name) -> Column:
    """The number between ``_utt_`` and ``__spk__``; null if there is none."""
    return F.nullif(F.regexp_extract(col(name), r"_utt_(\d+)__spk__", 1), F.lit("")).try_cast("int")


def numbers(c, kind: str = "double") -> Column:
    """A list of numbers from text between commas; a bad one is an error."""
    return F.transform(F.split(col(c), ","), lambda x: F.trim(x).cast(kind))
