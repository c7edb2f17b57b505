from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.llm import personal as P
from tidemark.llm.examples import example_lines

CASES = [
    ("Position Contact - Dr Joss B. Oskwick - +61 (0)3 7010-0027", {("NAME", "Joss B. Oskwick"), ("PHONE", "+61 (0)3 7010-0027")}),
    ("Post a signed form to 9/194 Old Mill Ave Oskander Bay NSW 5969, marked for the attention of V. Lorasby.", {("ADDRESS", "9/194 Old Mill Ave Oskander Bay NSW 5969"), ("NAME", "V. Lorasby")}),
    ("Current occupant Ms Renée L Haskembly, AGS number: 50629491, is on long leave.", {("NAME", "Renée L Haskembly"), ("ID_NUMBER", "50629491")}),
    ("Contact Officer: Ilka Ruthadell, 0855500697, ilka.ruthadell at gov (dot) arrivals (dot) example", {("NAME", "Ilka Ruthadell"), ("PHONE", "0855500697"), ("EMAIL", "ilka.ruthadell at gov (dot) arrivals (dot) example")}),
    ("This role reports to Grisaster, Ulric, who leads the section and can be reached by phone (1800 975 709).", {("NAME", "Grisaster, Ulric"), ("PHONE", "1800 975 709")}),
    ("Our ABN is 61 003 946 632.", set()), ("Quote position number 81145525 in your application.", set()), ("Tag us with @grisornecareers and tell a friend.", set()),
    ("Visit www.loradell.example/careers?id=771857 for the pack.", set()), ("The work is done under the Wendova Act 1980 and its regulations.", set()), ("See notice VN-73312648 of 23/1/2023 for a like role.", set()),
    ("File ref 2023/04334-178, budget line 4666 5766.", set()), ("The Pelmwick Street precinct reopens in 2027.", set()), ("", set()), ("\n\n", set()),
]


#: Sentences written by hand, of neither the generator of examples nor the tables: the pieces in them by kind.
HAND = [
    ("Talk to Angela Merriweather if the lift is stuck.", "NAME Angela Merriweather"), ("The hiring manager is Dr Wei Chen.", "NAME Wei Chen"), ("James Wilson will be happy to help.", "NAME James Wilson"),
    ("Reach Michael O'Brien by mobile 0412 345 678.", "NAME Michael O'Brien|PHONE 0412 345 678"), ("Priya Natarajan (0412 555 017) can assist.", "NAME Priya Natarajan|PHONE 0412 555 017"),
    ("My sister Fatima Al-Sayed drives the school bus.", "NAME Fatima Al-Sayed"), ("Our bookings desk answers on (03) 9555 0142 after lunch.", "PHONE (03) 9555 0142"), ("Text Nguyen, Thi if you are running late.", "NAME Nguyen, Thi"),
    ("Minutes taken by R. Castellano and approved on Tuesday.", "NAME R. Castellano"), ("Her tax file number is 123 456 782, which she must not share.", "ID_NUMBER 123 456 782"), ("He lost passport N1234567 in Lisbon.", "ID_NUMBER N1234567"),
    ("The parcel went to 14 Wattle Street, Bendigo VIC 3550 by mistake.", "ADDRESS 14 Wattle Street, Bendigo VIC 3550"), ("Cheques are posted to PO Box 1187, Dubbo NSW 2830.", "ADDRESS PO Box 1187, Dubbo NSW 2830"),
    ("You can reach the curator at m.delacroix@gallery.org.au any weekday.", "EMAIL m.delacroix@gallery.org.au"), ("helpdesk (at) library (dot) example replies within a day", "EMAIL helpdesk (at) library (dot) example"), ("Sales: 1300 555 212, service: 1800 555 998.", "PHONE 1300 555 212|PHONE 1800 555 998"),
    ("Yesterday Tom Ashdown and Lucy Fairbairn inspected the culvert.", "NAME Tom Ashdown|NAME Lucy Fairbairn"), ("We thank Professor Helen Zhao for her talk.", "NAME Helen Zhao"), ("Is Mrs Ivy Caldwell still the treasurer?", "NAME Ivy Caldwell"),
    ("Staff number 448213 belongs to a colleague in Perth.", "ID_NUMBER 448213"), ("Quote Medicare 2950 12345 1 on the claim.", "ID_NUMBER 2950 12345 1"), ("Driver licence no. 87654321 expires in June.", "ID_NUMBER 87654321"),
    ("From overseas dial +61 2 6555 0199.", "PHONE +61 2 6555 0199"), ("The crew boss, Sven Lindqvist, knows the valve.", "NAME Sven Lindqvist"), ("Olivia M. Hart, Deputy Registrar, signed the order.", "NAME Olivia M. Hart"),
    ("Visitors park behind Unit 3/88 Kingfisher Road, Cairns QLD 4870.", "ADDRESS Unit 3/88 Kingfisher Road, Cairns QLD 4870"), ("Leave keys with Abdul Rahim at the front gate.", "NAME Abdul Rahim"), ("The plaintiff, Mr K. Thornbury, lives in Geelong.", "NAME K. Thornbury"),
    ("Write to accounts@riverboats.com.au or fax 02 9555 0177.", "EMAIL accounts@riverboats.com.au|PHONE 02 9555 0177"), ("Ask for Beatriz Fonseca-Lima on arrival.", "NAME Beatriz Fonseca-Lima"), ("Nurse in charge tonight: Kwame Boateng", "NAME Kwame Boateng"),
    ("Employee ID E204417 was reissued.", "ID_NUMBER E204417"), ("Send flowers to 7 Rosella Court, Ballina NSW 2478.", "ADDRESS 7 Rosella Court, Ballina NSW 2478"), ("Her AGS number, 81234567, is on the payslip.", "ID_NUMBER 81234567"),
    ("Mail the form to Locked Bag 2040, Hobart TAS 7001.", "ADDRESS Locked Bag 2040, Hobart TAS 7001"), ("If in doubt email Jo.Blackwood@forestry.example first.", "EMAIL Jo.Blackwood@forestry.example"), ("After hours, ring 0498 765 432.", "PHONE 0498 765 432"),
    ("The lecture by Siobhan Kavanagh drew a crowd.", "NAME Siobhan Kavanagh"), ("Pavel Horak's sketch hangs in the foyer.", "NAME Pavel Horak"), ("Interpreter: Mei-Ling Tsai (mandarin)", "NAME Mei-Ling Tsai"), ("Payroll number 558120 was paid twice.", "ID_NUMBER 558120"),
    ("Our office moved to Level 9, 410 Collins Street, Melbourne VIC 3000 last year.", "ADDRESS Level 9, 410 Collins Street, Melbourne VIC 3000"), ("Contact: Harriet Vance, h.vance@skylark.test, 08 8555 0133", "NAME Harriet Vance|EMAIL h.vance@skylark.test|PHONE 08 8555 0133"),
    ("A copy goes to billing [at] dairyfarm [dot] example.", "EMAIL billing [at] dairyfarm [dot] example"), ("Passport no. PA7654321 was cancelled.", "ID_NUMBER PA7654321"), ("Customer reference number 204 555 871 is linked.", "ID_NUMBER 204 555 871"),
    ("The kiosk at 22 Marine Parade, Coolangatta QLD 4225 shuts at six.", "ADDRESS 22 Marine Parade, Coolangatta QLD 4225"), ("Reply Paid 771, Wollongong NSW 2500 needs no stamp.", "ADDRESS Reply Paid 771, Wollongong NSW 2500"), ("Rooms are at 5 Lachlan St, Forbes NSW 2871.", "ADDRESS 5 Lachlan St, Forbes NSW 2871"),
    ("Tickets: box.office@theatre.example", "EMAIL box.office@theatre.example"), ("Write in confidence to integrity-team@harbour.gov.au please.", "EMAIL integrity-team@harbour.gov.au"), ("news@tidepool.org.au is read daily", "EMAIL news@tidepool.org.au"), ("Try a.kowalczyk@museum.example instead.", "EMAIL a.kowalczyk@museum.example"),
    ("The farm is at Lot 12 Old Coach Road, Mudgee NSW 2850, past the dam.", "ADDRESS Lot 12 Old Coach Road, Mudgee NSW 2850"), ("Collect it from 3A Bank Lane, Albany WA 6330.", "ADDRESS 3A Bank Lane, Albany WA 6330"),
    ("The Fred Hollows Foundation restores sight.", ""), ("Parkinson's disease is studied at the Florey Institute.", ""), ("The Privacy Act 1988 applies to these records.", ""), ("Sydney Harbour Bridge opened in 1932.", ""), ("Our ABN is 53 004 085 616.", ""),
    ("The Nobel Prize was shared that year.", ""), ("Pages 1024 to 2048 are missing from file 2019/00412.", ""), ("Invoice 40558123 was settled in March.", ""), ("Version 10.15.7 fixes the Print Manager.", ""), ("Sales grew from 12 450 to 19 870 units.", ""),
    ("The Great Barrier Reef Marine Park Authority meets on Monday.", ""), ("Turn left into Macquarie Street and walk on.", ""), ("Follow @harbourmaster or see www.harbour.example/2024115.", ""), ("Tender RFT-204418 closes at noon.", ""), ("Senior Policy Officer, Climate and Energy", ""),
    ("Microsoft Excel and Power Query are used daily.", ""), ("READ THE SAFETY CARD BEFORE YOU ENTER THE WORKSHOP", ""), ("The Archibald Prize and the Burke Museum draw visitors.", ""), ("Room 4155 seats 120 people.", ""), ("Between 1998-2004 the Flinders University team wrote 415 reports.", ""),
]


@pytest.fixture(scope="module")
def finder():
    return P.Finder(P.models())


@pytest.mark.parametrize(("line", "want"), CASES)
def test_lines(finder, line, want):
    assert {(k, line[a:b]) for a, b, k in finder([line])[0]} == want


def test_names_of_common_words_are_proposed_and_can_be_found(finder):
    for name in ("Emily House", "Vic Orrova", "Li Po", "Anna Call", "Prize, Tom"):
        line = f"Ask {name} for the pack."
        assert name in {line[a:b] for _, a, b in P._proposed([line], finder.words)[0]["NAME"]}
    for line, name in (("Contact Officer: Emily House, 0855500697", "Emily House"), ("Contact Vic Orrova on 0855500697", "Vic Orrova")):
        assert ("NAME", name) in {(k, line[a:b]) for a, b, k in finder([line])[0]}


def test_sentences_written_by_hand(finder):
    hit, extra, missed, wrong = Counter(), Counter(), Counter(), []
    for line, pieces in HAND:
        want = {tuple(p.split(" ", 1)) for p in pieces.split("|") if p}
        got = {(k, line[a:b]) for a, b, k in finder([line])[0]}
        hit.update(k for k, _ in got & want)
        extra.update(k for k, _ in got - want)
        missed.update(k for k, _ in want - got)
        if got != want:
            wrong.append((line, got ^ want))
    for kind in P.KINDS:
        assert hit[kind] / (hit[kind] + missed[kind]) >= 0.9 and hit[kind] / (hit[kind] + extra[kind]) >= 0.9, (kind, hit, extra, missed, wrong)


def test_other_made_lines(finder):
    hit, extra, missed = Counter(), Counter(), Counter()
    made = example_lines(1500, 4242, finder.tools.ranks)
    for (_, spans, _), found in zip(made, P.find([line for line, *_ in made], finder.tools)):
        got, truth = set(found), set(spans)
        hit.update(k for *_, k in got & truth)
        extra.update(k for *_, k in got - truth)
        missed.update(k for *_, k in truth - got)
    for kind in P.KINDS:
        assert hit[kind] / (hit[kind] + missed[kind]) > 0.9 and hit[kind] / (hit[kind] + extra[kind]) > 0.93, (kind, hit, extra, missed)


def test_long_and_odd_texts(finder):
    for text in ("a" * 300_000, "A " * 100_000, "1 " * 100_000, "@" * 50_000, "x at y. " * 20_000, "Aa, " * 50_000):
        finder([text])


def test_columns(spark):
    rows = [(1, CASES[0][0] + "\nplain", CASES[0][0]), (1, CASES[0][0] + "\nplain", CASES[0][0]), (2, None, ""), (3, "nothing here", None), (2**60 + 1, CASES[0][0], None), (None, CASES[0][0], None)]
    df = spark.createDataFrame(rows, "doc long, a string, b string")
    got = {tuple(r) for r in P.find_personal(df, "doc", ["a", "b"]).distinct().collect()}
    assert got == {(1, f, k, t) for f in "ab" for k, t in CASES[0][1]} | {(d, "a", k, t) for d in (2**60 + 1, None) for k, t in CASES[0][1]}
    clean = {r["doc"]: r["c"] for r in df.select("doc", P.redact(F.col("a")).alias("c")).collect()}
    assert {k: v for k, v in clean.items() if k and k < 9} == {1: "Position Contact - Dr [NAME] - [PHONE]\nplain", 2: None, 3: "nothing here"}
    assert P.find_personal(df.limit(0), "doc", ["a"]).count() == 0
