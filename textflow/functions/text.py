"""Native (codegen'd) forms of the text stages, as Column expressions.

They give the same tokens as Spark ML's ``Tokenizer`` and
``StopWordsRemover`` but stay inside whole-stage codegen and can be used in
plain aggregations (vocabulary, document frequency) without a vector column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's ``\s`` class, which the ML Tokenizer splits on.
WHITESPACE_PATTERN = "[ \\t\\n\\x0B\\f\\r]"
WHITESPACE_CHARS = " \t\n\x0b\f\r"


def tokenize(text: Column | str) -> Column:
    """Lower-case and split on single whitespace characters.

    Java's ``String.split`` (used by the ML Tokenizer) drops trailing empty
    strings while SQL ``split`` keeps them; trimming the trailing whitespace
    first gives the Java result with one codegen'd split and no lambda.
    Leading and inner empty tokens stay, as in the ML stage; "" gives [""]
    (no separator matched) and all-whitespace text gives [].

    Letter case follows SQL ``lower``: with
    ``spark.sql.icu.caseMappings.enabled=false`` (set by
    :func:`textflow.session.build_session`) it is Java's mapping, identical
    to the ML stage; with ICU it can differ on context rules (a Greek capital
    sigma after a digit).
    """
    col = F.col(text) if isinstance(text, str) else text
    body = F.rtrim(F.lower(col), F.lit(WHITESPACE_CHARS))
    return (
        F.when(col.isNull(), F.lit(None))
        .when(col == F.lit(""), F.array(F.lit("")))
        .when(body == F.lit(""), F.array().cast("array<string>"))
        .otherwise(F.split(body, WHITESPACE_PATTERN))
    )


def tokenize_sql(text_sql: str) -> str:
    """DuckDB form of :func:`tokenize` (used by the oracle queries)."""
    ws = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    body = f"rtrim(lower({text_sql}), {ws})"
    return (
        f"(CASE WHEN {text_sql} IS NULL THEN NULL "
        f"WHEN {text_sql} = '' THEN [''] "
        f"WHEN {body} = '' THEN []::VARCHAR[] "
        f"ELSE string_split_regex({body}, '[ \\t\\n\\x0B\\f\\r]') END)"
    )


# The default English list of Spark's ``StopWordsRemover``
# (``StopWordsRemover.loadDefaultStopWords("english")``), in its order. Kept here
# as text so that importing a module or building oracle SQL needs no JVM, no
# session and no file; a test holds it against the running Spark's list.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't
wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't
shouldn't mustn't can't couldn't cannot could here's how's let's ought that's there's
what's when's where's who's why's would
""".split())


def default_stop_words() -> tuple[str, ...]:
    """The default English stop words (181 in Spark 4.1)."""
    return ENGLISH_STOP_WORDS


def remove_stop_words(tokens: Column | str, words: tuple[str, ...] | None = None) -> Column:
    """Case-insensitive stop-word removal over an array of tokens."""
    col = F.col(tokens) if isinstance(tokens, str) else tokens
    stop = [w.lower() for w in (words if words is not None else default_stop_words())]
    return F.filter(col, lambda t: ~F.lower(t).isin(stop))


def sql_string_list(values) -> str:
    """Render strings as a SQL literal list ``'a', 'b'`` (quotes doubled)."""
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
