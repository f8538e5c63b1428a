"""Words as the operators on word sequences define them."""

from __future__ import annotations

#: Bytes of a word (digits, a-z, everything beyond ASCII); the rest ends a word.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    """``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z in lower case,
    as UTF-8; none for a null text."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


#: The same in DuckDB SQL, for the column ``text``.
WORDS_SQL = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
