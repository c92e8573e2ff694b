"""Masking secrets in text columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tableflow.columns import col, require_columns

# The mask, the shortest literal secret worth masking, and the shapes that
# carry a credential. Spaces and word characters are the Unicode ones, spelled out so that
# every regex engine agrees on them.
MASK = "***"
MIN_SECRET_LENGTH = 3
_SPACE = r"\t-\r \x{85}\p{Z}"
_NO_WORD_BEFORE = r"(?<![\p{L}\p{Mn}\p{Nd}\p{Pc}])"

# Each pattern starts at one fixed character and looks behind it for the name, so the scan
# of a text without credentials stops only at those characters. The possessive repeat keeps
# Java from recursing once per character of a long value.
_SHAPES = [
    # Authorization: Bearer <token>, up to the next space
    (
        rf":(?<={_NO_WORD_BEFORE}(?i:Authorization):)[{_SPACE}]+(?i:Bearer)[{_SPACE}]+[^{_SPACE}]+",
        f": {MASK}",
    ),
    # "private_key": "<value>" and "private_key_id": "<value>", escapes allowed in the value
    (
        rf'"private_key(_id)?"([{_SPACE}]*:[{_SPACE}]*")(?:[^"\\]|\\[^\n])*+"',
        f'"private_key$1"$2{MASK}"',
    ),
    # access_token=, refresh_token= and client_secret= pairs
    (
        rf'=(?<={_NO_WORD_BEFORE}(?i:access_token|refresh_token|client_secret)=)(?:"[^"]*"|[^{_SPACE};,&]+)',
        f"={MASK}",
    ),
]


def redacted(text: Column, secrets: Iterable[str] = ()) -> Column:
    """``text`` with literal secrets masked, longest first, then the credential shapes."""
    literals = dict.fromkeys(s for s in secrets if len(s) >= MIN_SECRET_LENGTH)
    if literals:
        text = _masked(text, sorted(literals, key=len, reverse=True))
    for pattern, replacement in _SHAPES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def _masked(text: Column, secrets: Sequence[str]) -> Column:
    """What masking secret by secret in the order given gives, with a plan that does not grow with their number.

    Scanning once for the longest secret at each place gives the same, as long as no secret starts inside another and
    none holds characters of the mask. Only texts where that is so in fact are masked secret by secret.
    """
    pattern = _pattern(_trie(secrets))
    one_by_one = F.aggregate(F.array(*[F.lit(s) for s in secrets]), text, lambda t, s: F.replace(t, s, F.lit(MASK)))
    if any(MASK[0] in secret for secret in secrets):
        masked = one_by_one
    else:
        apart = F.regexp_count(text, F.lit(f"(?={pattern})")) == F.regexp_count(text, F.lit(pattern))
        masked = F.when(apart, F.regexp_replace(text, pattern, MASK)).otherwise(one_by_one)
    return F.when(text.rlike(pattern), masked).otherwise(text)


# A trie of secrets is a dict from a character to the trie behind it; this key marks the end of a secret.
_END = ""


def _trie(secrets: Iterable[str]) -> dict:
    trie: dict = {}
    for secret in secrets:
        node = trie
        for character in secret:
            node = node.setdefault(character, {})
        node[_END] = {}
    return trie


def _pattern(trie: dict) -> str:
    """The trie as a regular expression that matches its longest secret at a place."""
    out = []
    while True:
        branches = [(character, node) for character, node in trie.items() if character != _END]
        if len(branches) != 1 or _END in trie:
            break
        out.append(_literal(branches[0][0]))
        trie = branches[0][1]
    if branches:
        inner = "|".join(_literal(character) + _pattern(node) for character, node in branches)
        out.append(f"(?:{inner}){'?' if _END in trie else ''}")
    return "".join(out)


def _literal(character: str) -> str:
    return character if character.isascii() and character.isalnum() else f"\\x{{{ord(character):x}}}"


def redact_text(df: DataFrame, columns: Sequence[str], secrets: Iterable[str] = ()) -> DataFrame:
    """``df`` with the named text columns masked. NULL stays NULL."""
    require_columns(columns, df.columns, "text column")
    literals = list(secrets)
    return df.withColumns({name: redacted(col(name), literals) for name in columns})
