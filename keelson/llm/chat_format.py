r"""Chat formatting by schema fingerprints (DataFrame functions only).

Records of different layouts (turn rows, prompt/response, instruction/input/
output, message lists, ShareGPT-like conversations) are turned into canonical
turns. Each record is a VARIANT; its schema's nested field paths, without the
scalar types, are hashed, and the hash selects one declarative ``Layout``:
which path gives which role's text. A record with other fields besides takes
the layout with most paths of those that it has all fields of. Turns are then written in a template

    <|im_start|>ROLE\nTEXT<|im_end|>\n

with control strings escaped reversibly, and the loss mask covers assistant
texts only.

Escape: a run of n >= 0 backslashes between ``<`` and ``|`` gets one more, so
``<|`` never occurs inside a text; in roles, ``\`` and newlines are escaped
too. ``unescape`` takes it back.

Edge cases: a null text or role is empty. A record that no layout fits is
kept with ``layout`` null and no turns, and counted in ``n_unmatched``. Texts of any length are one value. Equal turn numbers are ordered by
role, then text; repeated rows are all kept. Rows whose id is null form one
conversation with a null id. Extra columns are ignored. An empty table gives
an empty table. A conversation is one output value, so its texts meet in one
row by nature; nothing else is gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The template's control strings.
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"

TURN = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))


@dataclass(frozen=True)
class Layout:
    """A declarative mapping of one record layout.

    ``paths``: all nested field paths of the record (``[]`` marks a list's
    element). ``turns``: (role, path) pairs, in order; or ``each``: the list's
    path with the names of its role and text fields. ``roles`` renames roles.
    """

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, str], ...] = ()
    each: tuple[str, str, str] | None = None
    roles: tuple[tuple[str, str], ...] = ()

    @property
    def shape(self) -> str:
        """The layout's paths in the form that ``path_shape`` gives for a record."""
        tree: dict = {}
        for p in self.paths:
            node = tree
            for part in p.replace("[]", ".[]").split("."):
                node = node.setdefault(part, {})

        def show(node: dict) -> str:
            if not node:
                return ""
            if "[]" in node:
                return f"ARRAY<{show(node['[]'])}>"
            return "OBJECT<" + ", ".join(f"{k}:{show(v)}" for k, v in sorted(node.items())) + ">"
        return show(tree)


_SHAREGPT = (("human", "user"), ("gpt", "assistant"), ("bot", "assistant"))

LAYOUTS = (
    Layout("turn", ("role", "text"), each=("", "role", "text")),
    Layout("prompt_response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt_completion", ("prompt", "completion"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("system_prompt_response", ("system", "prompt", "response"),
           (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("instruction_output", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction_input_output", ("instruction", "input", "output"),
           (("system", "instruction"), ("user", "input"), ("assistant", "output"))),
    Layout("question_answer", ("question", "answer"), (("user", "question"), ("assistant", "answer"))),
    Layout("messages", ("messages[].role", "messages[].content"), each=("messages", "role", "content")),
    Layout("conversations", ("conversations[].from", "conversations[].value"),
           each=("conversations", "from", "value"), roles=_SHAREGPT),
)


def path_shape(record: Column) -> Column:
    """The nested field paths of a VARIANT record, sorted, without scalar types."""
    schema = F.schema_of_variant(record)
    # scalar type names go; the structure words OBJECT and ARRAY stay
    bare = F.regexp_replace(schema, r"(?<=[:<] ?)(?!OBJECT<|ARRAY<)[A-Z]+(\(\d+(,\d+)?\))?(?=[,>]|$)", "")
    return F.regexp_replace(bare, r": ", ":")


def fingerprint(shape: Column) -> Column:
    """64-bit hash of a path shape."""
    return F.xxhash64(shape)


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # every first backslash starts a pair or a newline mark, so cutting at pairs never splits a mark
    cut = F.split(unescape(role), r"\\\\")
    return F.array_join(F.transform(cut, lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")


def _renamed(role: Column, layout: Layout) -> Column:
    for old, new in layout.roles:
        role = F.when(role == old, F.lit(new)).otherwise(role)
    return role


def _turns_of(record: Column, layout: Layout) -> Column:
    def text(path: str) -> Column:
        return F.coalesce(F.try_variant_get(record, "$." + path, "string"), F.lit(""))

    if layout.each is None:
        return F.array(*[F.struct(F.lit(r).alias("role"), text(p).alias("text")) for r, p in layout.turns])
    where, role, value = layout.each
    if not where:
        return F.array(F.struct(_renamed(text(role), layout).alias("role"), text(value).alias("text")))
    items = F.try_variant_get(record, f"$.{where}", f"array<struct<`{role}`:string,`{value}`:string>>")
    return F.transform(items, lambda m: F.struct(
        _renamed(F.coalesce(m[role], F.lit("")), layout).alias("role"), F.coalesce(m[value], F.lit("")).alias("text")))


def canonical_turns(df: DataFrame, record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """``df`` plus ``layout`` (name or null) and ``turns`` (array of role, text).

    ``record`` is a VARIANT column, for instance ``parse_json(line)`` or
    ``to_variant_object(struct(...))``.
    """
    shape = _free_name("_shape", df.columns)
    df = df.withColumn(shape, fingerprint(path_shape(record)))
    name, turns = F.lit(None).cast("string"), F.lit(None).cast(TURN)
    # from the last choice to the first: contained layouts by their number of paths, then the exact one
    choices = [(_contains(record, x), x) for x in sorted(layouts, key=lambda x: len(x.paths))]
    choices += [(F.col(shape) == fingerprint(F.lit(x.shape)), x) for x in reversed(layouts)]
    for hit, x in choices:
        name = F.when(hit, F.lit(x.name)).otherwise(name)
        turns = F.when(hit, _turns_of(record, x).cast(TURN)).otherwise(turns)
    return df.withColumns({"layout": name, "turns": F.coalesce(turns, F.array().cast(TURN))}).drop(shape)


def _contains(record: Column, layout: Layout) -> Column:
    """Whether a record has all fields that a layout reads, whatever else it has."""
    fields = [layout.each[0]] if layout.each and layout.each[0] else list(layout.paths)
    kind = "array<variant>" if layout.each and layout.each[0] else "variant"
    found = F.lit(True)
    for f in fields:
        found = found & F.try_variant_get(record, f"$.{f}", kind).isNotNull()
    return F.coalesce(found, F.lit(False))


def _free_name(name: str, taken: list[str]) -> str:
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def format_chats(df: DataFrame, record: Column, id_col: str = "conv_id", order_col: str | None = None) -> DataFrame:
    """One row a conversation: ``formatted``, ``loss_spans``, ``n_turns``, ``layouts``, ``n_unmatched`` (records without a layout).

    ``loss_spans``: array of (turn, start, in_turn, length), code points:
    ``start`` counts from the start of ``formatted``, ``in_turn`` from the end
    of the turn's start mark. Without ``order_col`` each record is a whole
    conversation; with it, the records of an id are put in its order.
    """
    order = F.col(order_col) if order_col else F.lit(0)
    turns = (canonical_turns(df.select(F.col(id_col).alias("_id"), order.alias("_order"), record.alias("_record")),
                             F.col("_record"))
             .select("_id", "_order", "layout", F.posexplode_outer("turns").alias("_at", "_turn")))
    pieces = turns.select(
        "_id", "layout", "_order", "_at", F.col("_turn.role").alias("role"), F.col("_turn.text").alias("raw"),
        F.col("_turn").isNotNull().alias("real"),
        F.concat(escape_role(F.col("_turn.role")), F.lit("\n")).alias("head"), escape(F.col("_turn.text")).alias("text"))
    pieces = pieces.withColumn("whole", F.when(F.col("real"), F.length("head") + F.length("text")
                                               + len(START) + len(END) + 1).otherwise(0).cast("long"))
    # the window and the aggregate share one exchange by id
    at = Window.partitionBy("_id").orderBy(F.col("real").desc(), "_order", "_at", "role", "raw")
    before = F.coalesce(F.sum("whole").over(at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.select("_id", "layout", F.when(F.col("real"), F.struct(
        F.row_number().over(at).cast("long").alias("turn"), (before + len(START) + F.length("head")).alias("start"),
        F.length("head").cast("long").alias("in_turn"), (F.col("role") == LOSS_ROLE).alias("loss"),
        "head", "text")).alias("p"))
    chats = placed.groupBy("_id").agg(
        F.sort_array(F.collect_list("p")).alias("p"), F.sort_array(F.collect_set("layout")).alias("layouts"),
        F.count_if(F.col("layout").isNull()).alias("n_unmatched"))
    return chats.select(
        F.col("_id").alias(id_col),
        F.array_join(F.transform("p", lambda x: F.concat(
            F.lit(START), x["head"], x["text"], F.lit(END + "\n"))), "").alias("formatted"),
        F.transform(F.filter("p", lambda x: x["loss"]), lambda x: F.struct(
            x["turn"].alias("turn"), x["start"].alias("start"), x["in_turn"].alias("in_turn"),
            F.length(x["text"]).cast("long").alias("length"))).alias("loss_spans"),
        F.size("p").cast("long").alias("n_turns"), "layouts", "n_unmatched")


def read_back(chats: DataFrame) -> DataFrame:
    """``chats`` plus what the formatted text says: ``turns_read`` (role, text) and ``loss_read``.

    The text is cut at the start marks; a turn ends in the end mark. The loss
    texts are cut out by ``loss_spans``.
    """
    parts = F.filter(F.split("formatted", START.replace("|", r"\|")), lambda x: x != "")
    chats = chats.withColumn("_parts", parts)
    turn = lambda x: F.struct(
        unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescape(F.substring(x, F.locate("\n", x) + 1, F.length(x) - F.locate("\n", x) - len(END) - 1)).alias("text"))
    loss = lambda s: unescape(F.substring(
        F.element_at("_parts", s["turn"].cast("int")), (s["in_turn"] + 1).cast("int"), s["length"].cast("int")))
    return chats.withColumns({"turns_read": F.transform("_parts", turn),
                              "loss_read": F.transform("loss_spans", loss)}).drop("_parts")


def digests(read: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """Digest columns of the texts read back."""
    loss = F.array_join("loss_read", "")
    said = F.array_join(F.transform("turns_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        id_col, F.size("turns_read").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
