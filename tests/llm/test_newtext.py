"""Newly written lines of mails: quotes, inline answers, signatures, notes; the trees."""

import numpy as np
import pytest

from lodestream.llm import newtext
from lodestream.llm.gbt import Boosted
from lodestream.llm.mailtext import intro_at, kind
from lodestream.llm.newtext import line_hashes, new_lines, parse

OPENING = """Hi Team,

We have an opening for Data Engineer with the field unit.
> 9 years needed in Quorvex, below that will be rejected.
Regards the rate, please stay within the card.
Disclaimer on my side - the unit may freeze 2 seats.

Kind regards,
Pelwin Eeshkova
Delivery Partner | Rovenza Digital
M: +971 555 1234

DISCLAIMER: Rovenza Digital takes no liability for any damage.
Registered office: 5 Some Street."""

TOP = """Thanks for the quick note.

Is the notice period flexible?
Sent: 7 resumes, cleared: 2.
--\x20
Neka Nalenley
TAG
w: veltrona.example

On Tue, 14 Apr 2026 at 10:32,
Pelwin Eeshkova <pelwin_eeshkova@rovenza.example> wrote:
""" + "\n".join(f"> {x}" if x else ">" for x in OPENING.split("\n"))

INLINE = """21 October 2025, 14:38, "Neka Nalenley" neka_nalenley@veltrona.example:
| Thanks for the quick note.
|
Yes, it is.
| 12 | Jenkins | 5 yrs | Mumbai |
| Is the notice period flexible?
| Sent: 7 resumes, cleared: 2.

> 6 years are needed.
| Key tasks without a quote

~ Pelwin ~
Sent from my phone"""

PASTED = "FYI below\n\nBest regards\nNeka Nalenley\n\n" + OPENING
FORWARD = "\n---------- Forwarded message ---------\nVon: Pelwin Eeshkova\nGesendet: 3 October 2025 10:00\nAn: Desk\nBetreff: Demand\n\n" + OPENING


def new_of(body, parent, sender, name):
    return [r[0] for r in parse(body, line_hashes(parent), sender, name) if not r[2] and not r[3] and kind(r[1]) not in ("legal", "closing")]


P = ("pelwin_eeshkova@rovenza.example", "Pelwin Eeshkova")
N = ("neka_nalenley@veltrona.example", "Neka Nalenley")


def test_lines():
    assert new_of(OPENING, None, *P) == [1, 3, 4, 5, 6]
    assert new_of(OPENING, None, P[0], None) == [1, 3, 4, 5, 6]
    assert new_of(TOP, OPENING, *N) == [1, 3, 4]
    assert new_of(TOP, None, *N) == [1, 3, 4]
    assert new_of(INLINE, TOP, *P) == [4, 5, 9, 10]
    assert new_of(INLINE, None, *P) == [4, 5, 9]
    assert new_of(PASTED, OPENING, *N) == [1]
    assert new_of(FORWARD, OPENING, *N) == new_of(FORWARD, None, *N) == []
    assert new_of(OPENING.replace("\n", "\r\n"), None, *P) == [1, 3, 4, 5, 6]


@pytest.mark.parametrize("line", ["On Sat the lead wrote: hold the profiles.", "From: Mon to Thu the panel is free, kindly block 90 minutes.", "Subject: to approval, we can go 9% above.", "Wed the group wrote that drivers come first:"])
def test_no_introduction(line):
    assert intro_at([line, "", "text"], 0) == 0


def varied(k):
    """The opening mail with other text and one of the sender's two signatures."""
    head, tail = OPENING.split("\n\nKind")
    if k % 2:
        return f"Hi {k},\n\nThe unit wants {k} people more.\n\n~ Pelwin ~\nSent from my phone"
    return head.replace("Hi Team", f"Hi {k}").replace("Data Engineer", f"Role {k}").replace("9 years", f"{k} years").replace("the rate", f"rate {k}").replace("2 seats", f"{k} seats") + "\n\nKind" + tail


def mails(spark, rows):
    return spark.createDataFrame(rows, "graph_id string, internet_message_id string, in_reply_to string, body_plain string, from_email string, from_name string")


def test_operator(spark):
    rows = [("a", "<a>", None, OPENING, *P), ("b", "<b>", "<a>", TOP, *N), ("b", "<b>", "<a>", TOP, *N), ("c", "<c>", "<b>", INLINE, *P), ("d", None, "<a>", PASTED, *N), ("e", None, "<lost>", FORWARD, None, None), ("f", None, None, None, *P), ("g", None, None, "", *P), (None, None, None, "x", *P)]
    rows += [(f"o{k}", None, None, varied(k), *P) for k in range(60)]
    found = [tuple(r) for r in new_lines(mails(spark, rows)).where("length(graph_id) = 1 and graph_id <> 'e'").collect()]
    assert len(found) == len(set(found))
    assert set(found) == {("a", 1), ("a", 3), ("a", 4), ("a", 5), ("a", 6), ("b", 1), ("b", 3), ("b", 4), ("c", 4), ("c", 5), ("c", 9), ("c", 10), ("d", 1)}
    assert new_lines(mails(spark, rows).limit(0)).count() == 0


def test_long_body(spark):
    body = "A line of new text.\n" * 20_000
    assert new_lines(mails(spark, [("a", None, None, body, *P)] + [(f"o{k}", None, None, varied(k), *P) for k in range(30)])).where("graph_id = 'a'").count() == 20_000


def test_trees_learn():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, 6)).astype(np.float32)
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] * x[:, 2] > 0)).astype(float)
    model = Boosted().fit(x[:3000], y[:3000])
    assert ((model.predict(x[3000:]) >= 0.5) == (y[3000:] == 1)).mean() > 0.9


def constant(probability):
    """A classifier without trees."""
    model = Boosted()
    model.edges, model.start = [np.zeros(0)] * len(newtext.FEATURES), float(np.log(probability / (1 - probability)))
    return model


def many(spark, senders=6, each=12):
    """Mails of several senders whose signatures no form gives away, with the true new lines."""
    rows, truth = [], set()
    for s in range(senders):
        for k in range(each):
            body = [f"Greetings {k}", f"The unit {s} asks for {k} people in week {k + s}.", "Kindly submit.", "", f"Person{s} Family{s}", f"house {s} of the long street", f"we at {s} like trees"]
            rows.append((f"m{s}-{k:02d}", f"<m{s}-{k}>", None, "\n".join(body), f"p{s}@d{s}.example", None))
            truth |= {(f"m{s}-{k:02d}", n) for n in (1, 2, 3)}
            if k % 2:
                answer = ["Thanks.", f"Sent {k} of {s}.", ""] + [f"> {x}" if x else ">" for x in body]
                rows.append((f"r{s}-{k:02d}", None, f"<m{s}-{k}>", "\n".join(answer), f"p{(s + 1) % senders}@d{(s + 1) % senders}.example", None))
                truth |= {(f"r{s}-{k:02d}", n) for n in (1, 2)}
    return mails(spark, rows), truth


def f1(found, truth):
    return 2 * len(found & truth) / (len(found) + len(truth))


def test_trees_decide(spark):
    rows, truth = many(spark)
    found = {tuple(r) for r in new_lines(rows).collect()}
    all_new = {tuple(r) for r in new_lines(rows, classifier=constant(0.9)).collect()}
    assert {tuple(r) for r in new_lines(rows, classifier=constant(0.1)).collect()} == set()
    assert found < all_new
    assert f1(found, truth) > 0.97 > 0.75 > f1(all_new, truth)


def test_sender_frequency_overturns_form(spark):
    """A signature without any known form comes out as old because its sender repeats it."""
    rows, truth = many(spark)
    found = {tuple(r) for r in new_lines(rows).collect()}
    formless = {(g, n) for g, n in {(r[0], r[1]) for r in truth} if g.startswith("m")}
    assert formless <= found
    assert not {(f"m{s}-{k:02d}", n) for s in range(6) for k in range(12) for n in (6, 7)} & found


def test_ancestor_decides_what_form_cannot(spark):
    """Text pasted without mark or introduction is old where the ancestor has it."""
    body = "Hello,\nwe need people.\nThey start soon."
    rows = [("a", "<a>", None, body, *P), ("b", None, "<a>", "Fine with us.\n\n" + body, *N)] + [(f"o{k}", None, None, OPENING, *P) for k in range(10)]
    found = {tuple(r) for r in new_lines(mails(spark, rows)).collect()}
    assert {r for r in found if r[0] == "b"} == {("b", 1)}


def test_no_evidence(spark):
    """Few mails, nothing repeated, no ancestor: the prior judges, no line is lost."""
    found = {tuple(r) for r in new_lines(mails(spark, [("a", None, None, TOP, *N)])).collect()}
    assert found == {("a", 1), ("a", 3), ("a", 4)}
    assert new_lines(mails(spark, [("e", None, "<lost>", FORWARD, None, None)])).count() == 0
