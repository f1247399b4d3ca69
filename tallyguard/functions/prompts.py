"""Prompt, answer and chat texts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyguard import fixed_values as fv
from tallyguard.functions.columns import as_col
from tallyguard.functions.draws import choice, draw_unit, sample_without_replacement

AMOUNT_LIMIT = 1.5         # fixed value: scaled amounts beyond this count as unusual
HIGH_CONFIDENCE_ABOVE = 0.3  # fixed value: share of MEDIUM confidence answers


# --- transaction text -------------------------------------------------------------------------

def feature_lines(df: DataFrame, cols: list[str] | None = None, label: str = "label") -> Column:
    """One ``  - name: value`` line per feature; floating-point values with four decimals.

    If every column (label included) is numeric, whole numbers are printed like floats as soon as
    one column is floating-point, because such a row has one common number type.
    """
    types = {f.name: f.dataType for f in df.schema}
    names = [c for c in (cols or df.columns) if c != label]
    row = set(names) | ({label} if label in types else set())
    floating = (T.DoubleType, T.FloatType)
    one_type = all(isinstance(types[c], T.NumericType) for c in row)
    any_float = any(isinstance(types[c], floating) for c in row)

    def shown(c: str) -> Column:
        t, value = types[c], F.col(f"`{c}`")
        if isinstance(t, floating) or (one_type and any_float):
            number = value.cast("double")
            return F.when(number.isNull() | F.isnan(number), F.lit("nan")).otherwise(
                F.format_string("%.4f", number))
        if isinstance(t, T.BooleanType):
            return F.when(value, "True").when(~value, "False").otherwise("None")
        return F.coalesce(value.cast("string"), F.lit("None"))

    return F.concat_ws("\n", *[F.concat(F.lit(f"  - {c}: "), shown(c)) for c in names])


def train_user_prompt(alias: str, lines: Column) -> Column:
    """User message of a training example."""
    context = fv.DATASET_CONTEXT.get(alias, fv.DEFAULT_CONTEXT)
    head = (f"{fv.TRAIN_USER_OPENING}\n\nDataset Context: {context}\n\nTransaction Features:\n")
    return F.concat(F.lit(head), lines, F.lit(f"\n\n{fv.TRAIN_USER_CLOSING}"))


def pair_lines(pairs: str | Column) -> Column:
    """``  - key: value`` lines of an ordered array of (key, value) pairs or of a map."""
    return F.array_join(
        F.transform(as_col(pairs), lambda p: F.concat(
            F.lit("  - "), p["key"], F.lit(": "), F.coalesce(p["value"], F.lit("None")))),
        "\n")


def feature_pairs(cols: list[str]) -> Column:
    """Ordered (key, value) pairs of the columns, values as plain text."""
    return F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                     for c in cols])


def inference_prompt(pairs: str | Column, context: str | Column | None = None) -> Column:
    """User message of a scoring request."""
    ctx = F.lit(fv.DEFAULT_CONTEXT) if context is None else as_col(context)
    return F.concat(
        F.lit(f"{fv.INFER_USER_OPENING}\n\nContext: "), ctx,
        F.lit("\n\nTransaction Features:\n"), pair_lines(pairs),
        F.lit(f"\n\n{fv.INFER_USER_CLOSING}"))


# --- answer -----------------------------------------------------------------------------------

def risk_level(score: str | Column) -> Column:
    """HIGH from 4, MEDIUM at 3, else LOW."""
    s = as_col(score)
    return F.when(s >= 4, "HIGH").when(s == 3, "MEDIUM").otherwise("LOW")


def recommended_action(score: str | Column) -> Column:
    """Action text of a risk score."""
    s = as_col(score)
    out = F
    for value, text in fv.RECOMMENDED_ACTIONS.items():
        out = out.when(s == value, text)
    return out.otherwise(fv.DEFAULT_ACTION)


def risk_indicators(df: DataFrame, is_fraud: Column, key: Column, seed: int | str = 42) -> Column:
    """Indicator list: for fraud an amount and a balance remark where the first such column is
    beyond the limit, then three drawn remarks; for legitimate rows two drawn remarks."""
    def first_beyond(part: str, remark: str) -> Column | None:
        hit = next((c for c in df.columns if part in c.lower()), None)
        if hit is None:
            return None
        beyond = F.abs(F.col(f"`{hit}`").cast("double")) > AMOUNT_LIMIT
        return F.when(beyond, F.array(F.lit(remark))).otherwise(F.array().cast("array<string>"))

    remarks = [r for r in (first_beyond("amount", fv.HIGH_AMOUNT_INDICATOR),
                           first_beyond("balance_diff", fv.BALANCE_INDICATOR)) if r is not None]
    drawn = sample_without_replacement(fv.FRAUD_INDICATORS, 3, key, "fraud-indicators", seed)
    fraud = F.concat(*remarks, drawn) if remarks else drawn
    legit = sample_without_replacement(fv.LEGIT_INDICATORS, 2, key, "legit-indicators", seed)
    return F.when(is_fraud, fraud).otherwise(legit)


def answer_fields(df: DataFrame, alias: str, is_fraud: Column, key: Column,
                  seed: int | str = 42) -> dict[str, Column]:
    """The eight answer fields in their fixed order."""
    score = F.when(is_fraud, choice([4, 5], key, "fraud-score", seed)).otherwise(
        choice([1, 2], key, "legit-score", seed))
    fraud_type = choice(fv.FRAUD_TYPES.get(alias, fv.DEFAULT_FRAUD_TYPES), key, "fraud-type", seed)
    typology = (F.when(is_fraud, choice(fv.AML_TYPOLOGIES[alias], key, "typology", seed))
                if alias in fv.AML_TYPOLOGIES else F.lit(None).cast("string"))
    return {
        "verdict": F.when(is_fraud, "FRAUD").otherwise("LEGITIMATE"),
        "risk_score": score,
        "risk_level": risk_level(score),
        "fraud_type": F.when(is_fraud, fraud_type),
        "aml_typology": typology,
        "risk_indicators": risk_indicators(df, is_fraud, key, seed),
        "recommended_action": recommended_action(score),
        "confidence": F.when(draw_unit(key, "confidence", seed) > HIGH_CONFIDENCE_ABOVE, "HIGH")
                       .otherwise("MEDIUM"),
    }


def fields_of_score(fields: dict[str, Column], score: Column) -> dict[str, Column]:
    """The answer fields with the score, level and action taken from the given score column."""
    return {**fields, "risk_score": score, "risk_level": risk_level(score),
            "recommended_action": recommended_action(score)}


# The short escapes of JSON.
ESCAPES = {"\\": "\\\\", '"': '\\"', "\n": "\\n"}
RARE_ESCAPES = {"\b": "\\b", "\t": "\\t", "\f": "\\f", "\r": "\\r"}
RARE = "[\\x00-\\x09\\x0B-\\x1F]"


def _replaced(c: Column, escapes: dict[str, str]) -> Column:
    for plain, escaped in escapes.items():
        c = F.replace(c, F.lit(plain), F.lit(escaped))
    return c


def json_escaped(c: Column) -> Column:
    """Text with backslashes, double quotes and all control signs escaped for JSON.

    Control signs other than line ends are rare; only a text that has one is searched for each.
    """
    rare = {chr(i): RARE_ESCAPES.get(chr(i), f"\\u{i:04x}") for i in range(32) if i != 10}
    return F.when(c.rlike(RARE), _replaced(_replaced(c, ESCAPES), rare)).otherwise(_replaced(c, ESCAPES))


def json_text(c: Column) -> Column:
    """A text (or null) as a JSON string token."""
    return F.coalesce(F.concat(F.lit('"'), json_escaped(c), F.lit('"')), F.lit("null"))


ITEM_MARK = "\x01"     # stands between list items while the joined text is escaped
ITEM_BREAK = '",\n    "'


def json_list(c: Column) -> Column:
    """A non-empty list of texts as JSON, one item per line. Joined before it is escaped, so no
    function runs per item, unless an item has a control sign other than a line end."""
    quick = F.replace(_replaced(F.array_join(c, ITEM_MARK), ESCAPES), F.lit(ITEM_MARK), F.lit(ITEM_BREAK))
    slow = F.array_join(F.transform(c, json_escaped), ITEM_BREAK)
    items = F.when(F.array_join(c, "").rlike(RARE), slow).otherwise(quick)
    return F.concat(F.lit('[\n    "'), items, F.lit('"\n  ]'))


def assistant_json(fields: dict[str, Column]) -> Column:
    """The answer as JSON text: two-space indent, one list item per line, nulls kept."""
    def token(name: str, c: Column) -> Column:
        if name == "risk_score":
            return c.cast("string")
        return json_list(c) if name == "risk_indicators" else json_text(c)

    lines = [F.concat(F.lit(f'  "{n}": '), token(n, c)) for n, c in fields.items()]
    return F.concat(F.lit("{\n"), F.concat_ws(",\n", *lines), F.lit("\n}"))


# --- example shapes ---------------------------------------------------------------------------

def example_metadata(dataset: str | Column, split: str | Column, label: str | Column) -> Column:
    """Struct {dataset, split, label, is_fraud}."""
    ds = F.lit(dataset) if isinstance(dataset, str) else dataset
    sp = F.lit(split) if isinstance(split, str) else split
    lab = as_col(label).cast("int")
    return F.struct(ds.alias("dataset"), sp.alias("split"), lab.alias("label"),
                    (lab == 1).alias("is_fraud"))


def message(role: str, content: str | Column) -> Column:
    """One chat message."""
    return F.struct(F.lit(role).alias("role"), as_col(content).alias("content"))


def to_chat_messages(examples: DataFrame, *keep: str) -> DataFrame:
    """System, user and assistant messages with the metadata and the columns to keep."""
    return examples.select(
        F.array(message("system", "system"), message("user", "user"),
                message("assistant", "assistant")).alias("messages"), "metadata", *keep)


def to_alpaca(examples: DataFrame) -> DataFrame:
    """Instruction (system, blank line, user), output and the metadata."""
    return examples.select(
        F.concat("system", F.lit("\n\n"), "user").alias("instruction"),
        F.col("assistant").alias("output"), "metadata")


FORMATS = {"chat": to_chat_messages, "alpaca": to_alpaca}


def format_switch(examples: DataFrame, output_format: str = "chat") -> DataFrame:
    """Convert examples to one of the two output formats."""
    if output_format not in FORMATS:
        raise ValueError(f"output_format must be one of {sorted(FORMATS)}")
    return FORMATS[output_format](examples)


# --- chat text --------------------------------------------------------------------------------

def turn_header(role: Column | str) -> Column:
    """Header of a turn."""
    r = F.lit(role) if isinstance(role, str) else role
    return F.concat(F.lit(fv.HEADER_START), r, F.lit(fv.HEADER_END))


def render_chat(messages: str | Column, add_generation_prompt: bool = False,
                after_header: str = "\n\n", turn_end: str = fv.TURN_END) -> Column:
    """Messages as one text; the generation flag appends an open assistant turn."""
    turns = F.transform(as_col(messages), lambda m: F.concat(
        turn_header(m["role"]), F.lit(after_header), m["content"], F.lit(turn_end)))
    text = F.array_join(turns, "")
    if add_generation_prompt:
        text = F.concat(text, turn_header("assistant"), F.lit(after_header))
    return text


def inference_chat(user: str | Column) -> Column:
    """Scoring prompt: system and user message with an open assistant turn."""
    return render_chat(F.array(message("system", F.lit(fv.INFER_SYSTEM_PROMPT)),
                               message("user", user)), add_generation_prompt=True)


RESPONSE_HEADER = f"{fv.HEADER_START}assistant{fv.HEADER_END}"


def completion_split(text: str | Column, header: str = RESPONSE_HEADER) -> Column:
    """Struct {prompt, completion}: split after the last assistant header; without a header the
    whole text is completion."""
    t = as_col(text)
    from_end = F.locate(header[::-1], F.reverse(t))
    cut = F.when(from_end > 0, F.length(t) - from_end + 1).otherwise(F.lit(0))
    return F.struct(F.left(t, cut).alias("prompt"),
                    F.substring(t, cut + F.lit(1), F.length(t)).alias("completion"))


def first_user_content(messages: str | Column) -> Column:
    """Content of the first user message, else empty."""
    users = F.filter(as_col(messages), lambda m: m["role"] == "user")
    return F.coalesce(F.try_element_at(users, F.lit(1))["content"], F.lit(""))


def metadata_or_default(metadata: str | Column) -> Column:
    """Struct {is_fraud 0/1, dataset}, with 0 and ``unknown`` where missing."""
    m = as_col(metadata)
    return F.struct(F.coalesce(m["is_fraud"].cast("int"), F.lit(0)).alias("is_fraud"),
                    F.coalesce(m["dataset"], F.lit("unknown")).alias("dataset"))


def preview(examples: DataFrame, n: int, order: str | Column) -> DataFrame:
    """First n examples in order, role-tagged and shortened for reading."""
    head = examples.orderBy(order).limit(n)
    if "messages" in examples.columns:
        shown = head.select(as_col(order).alias("example"), F.explode("messages").alias("m"))
        content = F.col("m.content")
        return shown.select(
            "example", F.concat(F.lit("["), F.upper("m.role"), F.lit("]")).alias("tag"),
            F.when(F.length(content) > 500, F.concat(F.substring(content, 1, 500), F.lit("...")))
            .otherwise(content).alias("shown"))
    parts = F.array(
        F.struct(F.lit("[INSTRUCTION]").alias("tag"), F.substring("instruction", 1, 400).alias("shown")),
        F.struct(F.lit("[OUTPUT]").alias("tag"), F.substring("output", 1, 400).alias("shown")))
    return head.select(as_col(order).alias("example"), F.explode(parts).alias("p")).select(
        "example", "p.tag", "p.shown")


def token_count(text: str | Column) -> Column:
    """Whitespace-separated tokens of the whole text."""
    return F.regexp_count(as_col(text), F.lit(r"\S+"))


def truncate_tokens(text: str | Column, limit: int) -> Column:
    """The first ``limit`` whitespace tokens, joined by single blanks."""
    t = F.btrim(F.regexp_replace(as_col(text), r"\s+", " "))
    return F.array_join(F.slice(F.split(t, " "), 1, limit), " ")
