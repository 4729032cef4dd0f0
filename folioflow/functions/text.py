"""Native text expressions: routing, decoding, truncation, blank tests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File type -> extension.
EXTENSIONS = {
    "PDF": "pdf",
    "DOCX": "docx",
    "DOC": "doc",
    "TXT": "txt",
    "RTF": "rtf",
    "ODT": "odt",
    "HTML": "html",
    "XML": "xml",
    "XLS": "xls",
    "XLSX": "xlsx",
    "JSON": "json",
}
# File types the fixed map lacks; used only when ``complete`` is asked for.
MISSING_EXTENSIONS = {
    "PNG": "png",
    "JPG": "jpg",
    "JPEG": "jpeg",
    "TIFF": "tiff",
    "CSV": "csv",
    "PPT": "ppt",
    "PPTX": "pptx",
    "OTHER": "bin",
}
DEFAULT_EXTENSION = "pdf"
IMAGE_EXTENSIONS = ["png", "jpg", "jpeg", "tiff", "bmp", "gif"]
TRUNCATION_MARKER = "\n\n[TEXTO TRUNCADO DEVIDO AO TAMANHO EXCESSIVO]"
ERROR_MARKER = "ERRO NA EXTRAÇÃO DE TEXTO"
MAX_FILE_BYTES = 100 * 1024 * 1024
MAX_TEXT_CHARS = 10 * 1024 * 1024
FALLBACK_TEXT_CHARS = 1_000_000
SUMMARY_CHARS = 1000
PREVIEW_CHARS = 100

# The code points Python's str.strip() removes.
_SPACE_RANGES = [
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
WHITESPACE = "".join(chr(c) for lo, hi in _SPACE_RANGES for c in range(lo, hi + 1))


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends (plain ``trim`` only knows U+0020)."""
    return F.btrim(text, F.lit(WHITESPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITESPACE))


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.length(strip(text)) == 0)


def shorten(text: Column, limit: int, tail: str) -> Column:
    """First ``limit`` characters plus ``tail`` where the text is longer."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit(tail))
    ).otherwise(text)


def truncate(text: Column, limit: int = MAX_TEXT_CHARS) -> Column:
    return shorten(text, limit, TRUNCATION_MARKER)


def fallback_truncate(
    text: Column, write_failed: Column, limit: int = FALLBACK_TEXT_CHARS
) -> Column:
    """The shorter form kept when storing the whole text was refused."""
    return F.when(write_failed, truncate(text, limit)).otherwise(text)


def summarize(text: Column) -> Column:
    return shorten(text, SUMMARY_CHARS, "...")


def preview(text: Column) -> Column:
    return shorten(text, PREVIEW_CHARS, "...")


def is_error_text(text: Column) -> Column:
    return F.coalesce(text.startswith(ERROR_MARKER), F.lit(False))


def file_extension(file_type: Column, complete: bool = False) -> Column:
    """Extension of a file type; unknown, numeric and missing types count as PDF."""
    table = {**EXTENSIONS, **MISSING_EXTENSIONS} if complete else EXTENSIONS
    pairs = F.str_to_map(F.lit(",".join(f"{k}:{v}" for k, v in table.items())))
    return F.coalesce(
        F.try_element_at(pairs, F.upper(file_type.cast("string"))), F.lit(DEFAULT_EXTENSION)
    )


def extractor(extension: Column) -> Column:
    """Which extraction branch reads a file: ``pages``, ``image`` or ``text``."""
    return (
        F.when(extension == "pdf", "pages")
        .when(extension.isin(IMAGE_EXTENSIONS), "image")
        .otherwise("text")
    )


def fold_newlines(text: Column) -> Column:
    lines = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    return F.replace(lines, F.lit("\r"), F.lit("\n"))


def decoded_as(content: Column) -> Column:
    """``utf-8`` where the bytes are valid UTF-8, else ``latin-1`` (accepts any bytes)."""
    return F.when(F.is_valid_utf8(content.cast("string")), F.lit("utf-8")).when(
        content.isNotNull(), F.lit("latin-1")
    )


def decode_text(content: Column, encoding: Column | None = None) -> Column:
    """Text of the bytes in the ``encoding`` that :func:`decoded_as` found."""
    encoding = decoded_as(content) if encoding is None else encoding
    text = F.when(encoding == "utf-8", content.cast("string")).otherwise(
        F.decode(content, "ISO-8859-1")
    )
    return fold_newlines(text)
