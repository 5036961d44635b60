import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tapelake.llm import chat_templates as chat


def render(template, turns):
    before, each, after = chat.compile_template(template)
    out = [before({**EMPTY})]
    out += [each({"role": r, "text": t, "index": k, "first": k == 0}) for k, (r, t) in enumerate(turns)]
    return [*out, after({**EMPTY})]


EMPTY = {"role": "", "text": "", "index": 0, "first": False}


def test_language():
    template = (
        "A{{ 'x' + 1 }}{% for turn in turns %}{% if first %}<{% elif not (role == 'b') and index != 2 %}-{% else %}={% endif %}"
        "{{ text | trim | upper }}{% if false %}never{% endif %}{% if true or role %}!{% else %}no{% endif %}{% endfor %}{# Z"
    )
    assert "".join(p for p, _ in render(template, [("a", " q "), ("c", "r"), ("b", "s")])) == "Ax1<Q!-R!=S!{# Z"


def test_folding_keeps_the_output_and_drops_what_is_constant():
    nodes = chat.parse("a{{ 'b' }}{% if 1 == 1 %}c{% else %}d{% endif %}{% for turn in turns %}{% if false %}x{% endif %}{{ text + 'y' }}{% endfor %}")
    assert chat.fold(nodes) == [("text", "abc"), ("for", [("print", ("+", ("name", "text"), ("const", "y")))])]


@pytest.mark.parametrize(
    "bad",
    ["x", "{% for turn in turns %}", "{% endfor %}", "{% for x in y %}{% endfor %}", "{% for turn in turns %}{{ os }}{% endfor %}", "{% for turn in turns %}{{ text.__class__ }}{% endfor %}",
     "{% for turn in turns %}{{ text | eval }}{% endfor %}", "{% for turn in turns %}{% import os %}{% endfor %}", "{% for turn in turns %}{{ (text }}{% endfor %}",
     "{% for turn in turns %}{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}{% endfor %}", "{% for turn in turns %}{% else %}{% endfor %}"],
)
def test_refused(bad):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(bad)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="&<[]/;ltampbrINST sé\n") | st.text())
def test_escape(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not set("<[]") & set(chat.escape(text))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "[/INST]", "a]b"]), st.text(alphabet="</s>[INST]& ok"))))
def test_turns_can_be_read_back(turns):
    pieces = render(chat.TEMPLATE, turns)
    assert [t for content, _ in pieces for t in chat.read_turns(content)] == turns
    loss = "".join(chat.unescape(content[a:b]) for content, spans in pieces for a, b in spans)
    assert loss == "".join(t for r, t in turns if r == "assistant")


def test_conversations(spark):
    rows = [(1, 1, "assistant", "ü<s>"), (1, 0, "user", "hi"), (2, 0, None, None), (2, 0, None, None), (None, 3, "assistant", "[ANS]"), (4, None, "user", "b"), (4, 0, "user", "a")]
    rows += [(5, k, "assistant", "x" * 1000) for k in range(3000)]
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, part int")
    pieces = chat.format_conversations(turns)
    got = {r.conv_id: r for r in chat.read_back(pieces).collect()}
    order = sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    assert set(got) == {r[0] for r in rows}
    texts = {r.conv_id: r for r in chat.documents_of(pieces).collect()}
    for conv, row in got.items():
        mine = [((r or ""), (t or "")) for c, _, r, t in order if c == conv]
        assert row.n_turns == len(mine)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in mine).encode()).hexdigest()
        loss = "".join(t for r, t in mine if r == "assistant")
        assert (row.loss_chars, row.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        whole = texts[conv].text
        assert row.formatted_chars == len(whole) and list(chat.read_turns(whole)) == mine
        assert "".join(chat.unescape(whole[s.low : s.high]) for s in texts[conv].loss) == loss
    assert chat.read_back(chat.format_conversations(turns.where("false"))).collect() == []
