"""Chat formatting: a template compiler and a streaming renderer and reader of conversations.

**Template language.** Text with ``{{ expression }}`` and ``{% statement %}``. Statements: ``for turn in turns`` (once, at the top
level) with ``endfor``, ``if`` / ``elif`` / ``else`` / ``endif``, and ``generation`` / ``endgeneration`` around what the loss covers.
Expressions: string and whole-number literals, ``true``, ``false``, the turn's ``role``, ``text``, ``index`` and ``first``, the
operators ``+ == != and or not`` and parentheses, and the filters ``trim``, ``lower``, ``upper`` (``a | trim``). There is nothing else:
no attributes, calls, subscripts or names of Python, so a template can't reach outside. ``+`` joins strings.

**Compiler.** ``parse`` gives a syntax tree of tuples, ``fold`` evaluates constant parts, drops dead branches and joins neighbouring
texts, and ``generate`` turns every node into a Python closure. ``compile_template`` returns the closures of what stands before,
inside and after the loop, so that turns are rendered one by one and a conversation of any length needs the memory of one turn.

**Escapes.** Every control string begins with ``<`` or ``[``. In roles and texts these, and the escape sign ``&`` itself, are written
``&lt;``, ``&lb;`` and ``&amp;``, so no text can imitate a mark, and reading is exact.

**Jobs.** ``format_conversations`` gives one row per piece of output: conv_id, part (0, then one per turn, then the end), start
(code points before it), content, loss (spans inside it). ``read_back`` reads pieces as a stream and returns digests. Conversations are
dealt by conv_id and sorted by turn; a digest of a whole conversation has to read its turns in order, and reads them one at a time,
so a conversation with a third of all rows costs time but no memory.

Defined results: null texts and roles count as empty; rows are ordered by turn (nulls first), role and text, so ties and repeated
rows have one order, and all of them are turns; rows with a null conv_id form one conversation. Only the four columns named are
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapelake.llm.common import shuffle_partitions

# Loss on what the assistant says; other roles are marked as instructions.
TEMPLATE = (
    "<s>{% for turn in turns %}"
    "{% if role == 'assistant' %}[ANS]{% generation %}{{ text }}{% endgeneration %}[/ANS]"
    "{% else %}[INST role={{ role }}]{{ text }}[/INST]{% endif %}"
    "{% endfor %}</s>"
)

# The escapes, in the order in which they are applied.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"), ("]", "&rb;"))

NAMES = ("role", "text", "index", "first")
FILTERS: dict[str, Callable] = {"trim": str.strip, "lower": str.lower, "upper": str.upper}


class TemplateError(ValueError):
    pass


def escape(text: str) -> str:
    for sign, code in ESCAPES:
        text = text.replace(sign, code)
    return text


def unescape(text: str) -> str:
    for sign, code in reversed(ESCAPES):
        text = text.replace(code, sign)
    return text


# ---- syntax -----------------------------------------------------------------------------------------------------------
# Tree: ("text", s) ("print", e) ("if", [(e, body), ...], else body) ("for", body) ("gen", body); expressions: ("const", v)
# ("name", n) ("filter", name, e) ("not", e) ("+" | "==" | "!=" | "and" | "or", a, b).
_TOKEN = re.compile(r"""\s*(?:(?P<string>'[^']*'|"[^"]*")|(?P<number>\d+)|(?P<word>[A-Za-z_]\w*)|(?P<sign>==|!=|[+|()]))""")


def _tokens(source: str) -> list[tuple[str, str]]:
    found, at = [], 0
    source = source.rstrip()
    while at < len(source):
        match = _TOKEN.match(source, at)
        if not match:
            raise TemplateError(f"unexpected {source[at:]!r}")
        found.append((match.lastgroup, match[match.lastgroup]))
        at = match.end()
    return found


class _Expression:
    """Recursive descent over the tokens of one expression: or, and, not, comparison, +, filters, atoms."""

    def __init__(self, source: str) -> None:
        self.tokens, self.at = _tokens(source), 0

    def whole(self):
        tree = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return tree

    def take(self, *wanted: str) -> str | None:
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def chain(self, part: Callable, *signs: str):
        tree = part()
        while sign := self.take(*signs):
            tree = (sign, tree, part())
        return tree

    def either(self):
        return self.chain(self.both, "or")

    def both(self):
        return self.chain(self.negated, "and")

    def negated(self):
        return ("not", self.negated()) if self.take("not") else self.chain(self.joined, "==", "!=")

    def joined(self):
        return self.chain(self.filtered, "+")

    def filtered(self):
        tree = self.atom()
        while self.take("|"):
            name = self.tokens[self.at][1] if self.at < len(self.tokens) else ""
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            tree = ("filter", name, tree)
        return tree

    def atom(self):
        if self.take("("):
            tree = self.either()
            if not self.take(")"):
                raise TemplateError("missing )")
            return tree
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("", "end")
        self.at += 1
        if kind == "string":
            return ("const", value[1:-1])
        if kind == "number":
            return ("const", int(value))
        if value in ("true", "false"):
            return ("const", value == "true")
        if kind == "word" and value in NAMES:
            return ("name", value)
        raise TemplateError(f"unexpected {value!r}")


def parse(template: str) -> list[tuple]:
    """The syntax tree of a template: a list of nodes."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", template, flags=re.DOTALL)
    root: list[tuple] = []
    stack: list[tuple[str, list]] = [("", root)]  # what is open, and where its nodes go
    for piece in pieces:
        body = stack[-1][1]
        if piece.startswith("{{"):
            body.append(("print", _Expression(piece[2:-2]).whole()))
        elif not piece.startswith("{%"):
            if piece:
                body.append(("text", piece))
        else:
            word, _, rest = piece[2:-2].strip().partition(" ")
            if word == "for":
                if rest.split() != ["turn", "in", "turns"] or len(stack) > 1 or any(node[0] == "for" for node in root):
                    raise TemplateError("the only loop is 'for turn in turns', once and at the top")
                body.append(("for", []))
                stack.append(("for", body[-1][1]))
            elif word == "generation":
                if any(name == "generation" for name, _ in stack):
                    raise TemplateError("generation inside generation")
                body.append(("gen", []))
                stack.append((word, body[-1][1]))
            elif word == "if":
                body.append(("if", [(_Expression(rest).whole(), [])], []))
                stack.append((word, body[-1][1][-1][1]))
            elif word in ("elif", "else"):
                if stack[-1][0] != "if":
                    raise TemplateError(f"{word} without if")
                stack.pop()
                node = stack[-1][1][-1]
                if word == "elif":
                    node[1].append((_Expression(rest).whole(), []))
                stack.append(("if", node[1][-1][1]) if word == "elif" else ("else", node[2]))
            elif word in ("endfor", "endif", "endgeneration"):
                if stack[-1][0] not in {"endfor": ("for",), "endif": ("if", "else"), "endgeneration": ("generation",)}[word]:
                    raise TemplateError(f"{word} closes nothing")
                stack.pop()
            else:
                raise TemplateError(f"no statement {word!r}")
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not closed")
    return root


# ---- constant folding ---------------------------------------------------------------------------------------------------
def _as_text(value) -> str:
    return value if isinstance(value, str) else str(value).lower() if isinstance(value, bool) else str(value)


_BINARY: dict[str, Callable] = {
    "+": lambda a, b: _as_text(a) + _as_text(b),
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "and": lambda a, b: a and b,
    "or": lambda a, b: a or b,
}


def fold_expression(tree: tuple) -> tuple:
    kind = tree[0]
    if kind in _BINARY:
        a, b = fold_expression(tree[1]), fold_expression(tree[2])
        if a[0] == "const" and (b[0] == "const" or kind == "and" and not a[1] or kind == "or" and a[1]):
            return ("const", _BINARY[kind](a[1], b[1] if b[0] == "const" else None))
        return (kind, a, b)
    if kind in ("not", "filter"):
        inner = fold_expression(tree[-1])
        if inner[0] == "const":
            return ("const", not inner[1] if kind == "not" else FILTERS[tree[1]](_as_text(inner[1])))
        return (*tree[:-1], inner)
    return tree


def fold(nodes: list[tuple]) -> list[tuple]:
    """The same output from fewer nodes: constants evaluated, dead branches dropped, neighbouring texts joined."""
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "print":
            tree = fold_expression(node[1])
            node = ("text", escape(_as_text(tree[1]))) if tree[0] == "const" else ("print", tree)
            more = [node]
        elif node[0] == "if":
            branches, rest = [], fold(node[2])
            for test, body in node[1]:
                tree = fold_expression(test)
                if tree[0] == "const" and not tree[1]:
                    continue
                if tree[0] == "const":
                    rest = fold(body)
                    break
                branches.append((tree, fold(body)))
            more = [("if", branches, rest)] if branches else rest
        elif node[0] in ("for", "gen"):
            more = [(node[0], fold(node[1]))]
        else:
            more = [node]
        for one in more:
            if one[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + one[1])
            elif one != ("text", ""):
                out.append(one)
    return out


# ---- closures -----------------------------------------------------------------------------------------------------------
def generate_expression(tree: tuple) -> Callable[[dict], object]:
    kind = tree[0]
    if kind == "const":
        value = tree[1]
        return lambda turn: value
    if kind == "name":
        name = tree[1]
        return lambda turn: turn[name]
    if kind == "not":
        inner = generate_expression(tree[1])
        return lambda turn: not inner(turn)
    if kind == "filter":
        change, inner = FILTERS[tree[1]], generate_expression(tree[2])
        return lambda turn: change(_as_text(inner(turn)))
    a, b = generate_expression(tree[1]), generate_expression(tree[2])
    if kind == "and":
        return lambda turn: a(turn) and b(turn)
    if kind == "or":
        return lambda turn: a(turn) or b(turn)
    combine = _BINARY[kind]
    return lambda turn: combine(a(turn), b(turn))


def generate(nodes: list[tuple]) -> Callable[[dict, list, list], None]:
    """A closure (turn, out, spans) that appends the output to ``out`` and loss spans, as positions in ``out``, to ``spans``."""
    steps = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda turn, out, spans, text=node[1]: out.append(text))
        elif node[0] == "print":
            steps.append(lambda turn, out, spans, value=generate_expression(node[1]): out.append(escape(_as_text(value(turn)))))
        elif node[0] == "gen":

            def marked(turn, out, spans, inner=generate(node[1])):
                start = len(out)
                inner(turn, out, spans)
                spans.append((start, len(out)))

            steps.append(marked)
        else:
            tests = [(generate_expression(test), generate(body)) for test, body in node[1]]

            def chosen(turn, out, spans, tests=tests, rest=generate(node[2])):
                for test, body in tests:
                    if test(turn):
                        return body(turn, out, spans)
                return rest(turn, out, spans)

            steps.append(chosen)

    def run(turn, out, spans):
        for step in steps:
            step(turn, out, spans)

    return run


def compile_template(template: str) -> list[Callable[[dict], tuple[str, list[tuple[int, int]]]]]:
    """Renderers of what stands before the loop, of one turn, and of what stands after it.

    Each gives its output and the loss spans in it, in code points.
    """
    nodes = fold(parse(template))
    loop = next((k for k, node in enumerate(nodes) if node[0] == "for"), None)
    if loop is None:
        raise TemplateError("a template needs the loop over turns")

    def renderer(part: list[tuple]):
        run = generate(part)

        def render(turn: dict) -> tuple[str, list[tuple[int, int]]]:
            out: list[str] = []
            spans: list[tuple[int, int]] = []
            run(turn, out, spans)
            ends = [0]
            for text in out:
                ends.append(ends[-1] + len(text))
            return "".join(out), [(ends[a], ends[b]) for a, b in spans]

        return render

    return [renderer(nodes[:loop]), renderer(nodes[loop][1]), renderer(nodes[loop + 1 :])]


# ---- reading back -------------------------------------------------------------------------------------------------------
# How the default template's turns look in its output.
_TURN = re.compile(r"\[ANS\](?P<answer>[^\[]*)\[/ANS\]|\[INST role=(?P<role>[^\]]*)\](?P<text>[^\[]*)\[/INST\]")


def read_turns(content: str) -> Iterator[tuple[str, str]]:
    """(role, text) of the turns in a piece of output of the default template."""
    for found in _TURN.finditer(content):
        if found["answer"] is not None:
            yield "assistant", unescape(found["answer"])
        else:
            yield unescape(found["role"]), unescape(found["text"])


# ---- jobs ---------------------------------------------------------------------------------------------------------------
PIECES = "conv_id long, part long, start long, content string, loss array<struct<low:long,high:long>>"
_LOSS = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
_PIECE_CHARS = 1 << 20


def _format(template: str):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, each, after = compile_template(template)
        rows: list[tuple] = []
        held = 0
        current, part, place = None, -1, 0  # of the open conversation; part -1: none is open

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string(), _LOSS), strict=True)], ["conv_id", "part", "start", "content", "loss"])

        def add(render: Callable, turn: dict) -> None:
            nonlocal part, place, held
            content, spans = render(turn)
            rows.append((current, part, place, content, [{"low": a, "high": b} for a, b in spans]))
            part, place, held = part + 1, place + len(content), held + len(content)

        nothing = {"role": "", "text": "", "index": 0, "first": False}
        for batch in batches:
            for conv, role, text in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "role", "text")), strict=True):
                if part < 0 or conv != current:
                    if part >= 0:
                        add(after, nothing)
                    current, part, place = conv, 0, 0
                    add(before, nothing)
                add(each, {"role": role or "", "text": text or "", "index": part - 1, "first": part == 1})
                if held > _PIECE_CHARS:
                    yield flushed()
                    rows.clear()
                    held = 0
        if part >= 0:
            add(after, nothing)
        yield flushed()

    return pieces


def format_conversations(conversations: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Pieces of formatted output (see the module), each conversation's in order within one partition."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")
    ).withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    dealt = rows.repartition(shuffle_partitions(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.mapInArrow(_format(template), PIECES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
    state = None
    for batch in batches:
        done = []
        for conv, part, content, loss in zip(*(batch.column(name).to_pylist() for name in ("conv_id", "part", "content", "loss")), strict=True):
            if part == 0:
                if state:
                    done.append(state)
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
            for role, text in read_turns(content):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            for span in loss:
                text = unescape(content[span["low"] : span["high"]])
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(content)
        if done:
            yield _digest_rows(done, names, kinds)
    if state:
        yield _digest_rows([state], names, kinds)


def _digest_rows(states: list[list], names, kinds) -> pa.RecordBatch:
    rows = [(a, b, c.hexdigest(), d, e.hexdigest(), f) for a, b, c, d, e, f in states]
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], list(names))


def read_back(pieces: DataFrame) -> DataFrame:
    """A row per conversation, read from the output of the default template: conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars. ``pieces`` must come in order within partitions, as ``format_conversations`` gives them."""
    return pieces.mapInArrow(_digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def documents_of(pieces: DataFrame) -> DataFrame:
    """Whole formatted conversations (conv_id, text, loss spans over the text), for those that fit into a row."""
    spans = F.transform("loss", lambda s: F.struct((s.low + F.col("start")).alias("low"), (s.high + F.col("start")).alias("high")))
    ordered = F.array_sort(F.collect_list(F.struct("part", "content", spans.alias("loss"))))
    rows = pieces.groupBy("conv_id").agg(ordered.alias("pieces"))
    return rows.select("conv_id", F.array_join("pieces.content", "").alias("text"), F.flatten(F.col("pieces.loss")).alias("loss"))
