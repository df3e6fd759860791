"""The patch of a pull request: where it comes from, what is left out, how much is kept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.paths import is_noise, without_noise
from ..functions.redact import redact
from ..functions.text import cap, filled, let, or_empty, section_of, strip, utf8_prefix

MAX_BYTES, SPARE_BYTES, LEAST_BYTES, LISTED_FILES, NAMED_FILES = 96 * 1024, 80, 1024, 40, 20
END = "\n\n# … truncated …\n"


def file_patches(files: Column) -> Column:
    """The files' own patches one after the other; a file whose patch is missing is said to be."""

    def shown(f: Column) -> Column:
        name = F.coalesce(filled(f["filename"]), F.lit("unknown"))
        gone = F.coalesce(f["patch_truncated"], F.lit(False)) | (f["status"].isNotNull() & (f["status"] != "removed"))
        note = F.concat(F.lit("# omitted: "), name, F.lit(" (patch unavailable / truncated from files API)"))
        text = F.concat(F.lit("--- a/"), name, F.lit("\n+++ b/"), name, F.lit("\n"), f["patch"])
        return F.when(filled(f["patch"]).isNotNull(), text).when(gone, note)

    return F.array_join(F.array_compact(F.transform(clean_files(files), shown)), "\n")


def clean_files(files: Column) -> Column:
    return F.coalesce(F.filter(files, lambda f: ~F.coalesce(is_noise(f["filename"]), F.lit(False))), F.slice(files, 1, 0))


def diff_text(inline: Column, sidecar: Column, files: Column) -> Column:
    """The inline diff, or else the one kept beside the record, without noise; or else the files' patches."""
    said = F.when(strip(or_empty(inline)) != "", inline)
    return F.coalesce(without_noise(F.coalesce(said, sidecar)), file_patches(files), F.lit(""))


def names(files: Column) -> Column:
    return F.filter(F.transform(files, lambda f: f["filename"]), lambda n: filled(n).isNotNull())


def patch(inline: Column, sidecar: Column, files: Column, max_bytes: int = MAX_BYTES) -> Column:
    """The redacted diff within a budget of bytes: beyond it a list of files, a prefix and a mark of its end."""

    def budgeted(full: Column) -> Column:
        line = lambda f: F.concat(F.lit("# "), F.coalesce(f["status"], F.lit("None")), F.lit(": "), F.coalesce(f["filename"], F.lit("None")), F.lit(" (+"), F.coalesce(f["additions"].cast("string"), F.lit("None")), F.lit("/-"), F.coalesce(f["deletions"].cast("string"), F.lit("None")), F.lit(")"))

        def cut(mine: Column) -> Column:
            count = F.coalesce(F.size(mine), F.lit(0))
            first = F.concat(F.lit("# Truncated unified diff for training (full raw under datasets/raw/; "), F.octet_length(full).cast("string"), F.lit(" bytes, "), count.cast("string"), F.lit(" files)"))
            listed = F.coalesce(F.transform(F.slice(mine, 1, LISTED_FILES), line), F.array().cast("array<string>"))
            header = F.concat(F.array_join(F.concat(F.array(first), listed), "\n"), F.lit("\n\n"))
            return let(header, lambda h: F.concat(h, utf8_prefix(full, F.greatest(F.lit(max_bytes) - F.octet_length(h) - SPARE_BYTES, F.lit(LEAST_BYTES))), F.lit(END)))

        missing = F.concat(F.lit("# Patch unavailable from API; changed files: "), F.coalesce(filled(F.array_join(names(clean_files(files)), ", ")), F.lit("(none)")), F.lit("\n"))
        return F.when(strip(full) == "", missing).when(F.octet_length(full) <= max_bytes, full).otherwise(let(clean_files(files), cut))

    return let(redact(diff_text(inline, sidecar, files)), budgeted)


def before_context(title: Column, outlined: Column, files: Column) -> Column:
    """Title, names of the changed files, and the summary. outlined: of the body without boilerplate."""

    def listed(mine: Column) -> Column:
        shown = F.array_join(names(F.slice(mine, 1, NAMED_FILES)), ", ")
        return let(filled(shown), lambda x: F.coalesce(F.concat(F.lit("Changed files ("), F.size(mine).cast("string"), F.lit("): "), x), F.lit("Changed files: (none listed)")))

    summary = cap(section_of(outlined, ("summary", "user description", "what changed")), 1200)
    return redact(F.concat_ws("\n", F.concat(F.lit("PR title: "), or_empty(title)), let(clean_files(files), listed), F.concat(F.lit("Motivation/summary:\n"), summary)))
