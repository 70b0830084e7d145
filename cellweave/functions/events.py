"""JSON event fields, keyword tracking and stable sampling."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Characters of a token; everything else separates tokens.
NOT_TOKEN = r"[^\p{L}\p{N}_#@]+"
_SAMPLE_RANGE = 1 << 32


def has_keys(json: Column, names: Sequence[str]) -> Column:
    """True when a JSON object has all the keys, even with null values.

    NULL for text that is no JSON object.
    """
    found = F.array_intersect(F.json_object_keys(json), F.array(*[F.lit(n) for n in sorted(set(names))]))
    return F.array_size(found) == len(set(names))


def parsed_with_keys(json: Column, schema: StructType, names: Sequence[str]) -> Column:
    """An array of the one struct that a JSON object with all the keys holds; an empty one for other text.

    The text is parsed once. Only where a key's value is null, which a struct cannot tell from
    a missing key, are the keys themselves read. Explode it: conditions on the
    struct then stay behind the parse and do not repeat it.
    """
    some_null = lambda m: reduce(or_, [m[n].isNull() for n in sorted(set(names))])
    return F.filter(F.array(F.from_json(json, schema)), lambda m: ~some_null(m) | has_keys(json, names))


def millis_timestamp(text: Column) -> Column:
    """Epoch milliseconds held as text; NULL when the text is no number."""
    return F.timestamp_millis(text.try_cast("long"))


def tokens(text: Column) -> Column:
    return F.split(F.lower(text), NOT_TOKEN)


def tracks(text: Column, phrases: Sequence[str]) -> Column:
    """True when the text has all words of any phrase, whatever their case and order.

    A plain word also matches the hashtag and the mention of that word; a
    phrase word that starts with ``#`` or ``@`` matches only itself.

    The text is split once, for any number of phrases. A phrase is looked at
    only where the text has its rarest word, the one that the fewest phrases have.
    """
    wanted = sorted({tuple(sorted(set(p.lower().split()))) for p in phrases} - {()})
    if not wanted:
        return F.lit(False)
    uses = Counter(word for words in wanted for word in words)
    by_rarest: dict[str, list[list[str]]] = {}
    for words in wanted:
        rarest = min(words, key=lambda w: (uses[w], -len(w), w))
        by_rarest.setdefault(rarest, []).append([w for w in words if w != rarest])
    rest = F.create_map(
        *[F.lit(x) for word, others in by_rarest.items() for x in (word, others)]
    ).cast("map<string,array<array<string>>>")
    alone = [word for word, others in by_rarest.items() if [] in others]
    several = [word for word in by_rarest if word not in set(alone)]

    def whole(found: Column, word: Column) -> Column:
        has_all = lambda words: F.forall(words, lambda w: F.array_contains(found, w))
        return F.exists(F.try_element_at(rest, word), has_all)

    def met(found: Column) -> Column:
        hit = F.exists(found, lambda t: t.isin(alone)) if alone else F.lit(False)
        if not several:
            return hit
        return hit | F.exists(found, lambda t: t.isin(several) & whole(found, t))

    # Bound by lambdas, so that the split is evaluated once.
    return F.exists(F.transform(F.array(tokens(text)), _forms), met)


def _forms(found: Column) -> Column:
    """Tokens, and the plain words of hashtags and mentions."""
    marked = lambda t: F.substring(t, 1, 1).isin("#", "@")
    plain = F.transform(F.filter(found, marked), lambda t: F.substring(t, 2, 2**31 - 1))
    return F.concat(found, F.filter(plain, lambda t: ~marked(t) & (t != "")))


def in_sample(key: Column, fraction: float) -> Column:
    """True for a stable share of the keys.

    It depends on the key alone, so a batch, a stream and a retried task all
    choose the same rows.
    """
    digest = F.substring(F.md5(key.cast("string")), 1, 8)
    return F.conv(digest, 16, 10).cast("long") < F.lit(round(fraction * _SAMPLE_RANGE))
