"""Made lines with marked personal information, for fitting and calibrating ``llm.personal``.

Lines follow a general grammar of English: a person, number, address or mailbox stands as subject, object,
label, apposition, signature or list item, in clauses filled with common words drawn by rank from a public
vocabulary, or simply at a random place between such words. Other lines hold what only looks like it: bodies, places,
works and things named after people, titles of posts, headings, figures and references. All names and numbers
are invented. Every form has a number, so that whole forms can be held out.
"""

from __future__ import annotations

import random
import re
from collections.abc import Callable

from tidemark.llm.lexicon import capital_words, common_words

Part = tuple[str, str | None]
_GIVEN = (
    "Alma Boris Clea Dario Edith Frans Greta Hugo Imke Jonas Karla Leif Minna Noel Olga Piet Ruta Sven Tilda Uwe Vera Willem Yara Zeno Renée Anaïs Aisha Bao Chidi Divya Emre Fatima Gwen Hana Ivan "
    "Jin Kofi Lucía Mei Nadia Omar Pavel Quan Rosa Siobhán Tomás Uma Vikram Wen Ximena Yusuf Zoë Anne Ben Cate Dan Ella Finn Grace Harry Iris Jack Kate Liam Mark Nina Owen Paul Rose Sam Tess Will"
).split()
_HEADS, _TAILS = "bran cor dal fen gar hol kel lam mar nor ol pel quin rus sten tor ul var wen zan be chi do fu gri ha jo ka li mo na pa ri sa ta vi wu xi ya ze".split(), "by dale er ford ham ik mund ova sson ton uin vane wick worth iga ng n ra ski lo nen oto ez shi la tti mann ic dou ev aj ou".split()
_FAMILY = (
    "Smith Jones Williams Wilson Taylor Johnson Martin Anderson Thompson Nguyen Thomas Walker Harris Lee Ryan Robinson Kelly Chen Singh Patel Kumar Wang Zhang Li Tran Le Murphy O'Brien O'Connor O’Neill Campbell Mitchell "
    "Roberts Evans Edwards Clarke Morris Hughes Watson Morrison Fraser Graham Garcia Rossi Russo Papadopoulos Kowalski Novak Schmidt Müller Ivanov Haddad Khan Ahmed Ali Hassan Okafor Mensah Tanaka Suzuki Kim Park Choi Reyes Santos Silva Cohen Levy"
).split()
#: Names that are common words as well.
_PLAIN = "House Park Hill Young Wood Stone Rivers Field Banks Church Street Lane Page Cook Baker Carter Mason Hall Rice Price Long Short Sharp Gray Black White Brown Green King Knight Bishop Pope Day Winter Summers Berry Bird Fox Wolf Lamb Rose Vale Bay Marsh Bridges Mills Post Bell Ring Call".split()
_TOWN_ENDS = "Bay|Creek|Flat|Vale|Point|Hill|Heads|Springs|Valley|Beach|Park|North|Junction|Island|Falls|Harbour|Plains|Ridge|River".split("|")
_TOWN_STARTS = "Mount|Port|Lake|Cape|Upper|Lower|New|Old|West|East|South|North|Point|Glen|Fort".split("|")
_KINDS_OF_STREET = "Street St Road Rd Avenue Ave Terrace Tce Drive Dr Lane Way Parade Pde Crescent Cres Place Pl Court Ct Highway Hwy Boulevard Circuit Close Grove Square Esplanade".split()
_STATES = "NSW VIC Vic Qld QLD SA WA Tas TAS ACT NT Victoria Queensland Tasmania".split()
_BODY = "Department Office Agency Bureau Authority Commission Council Tribunal Board Service Institute Museum Branch Division Section Group Directorate Unit Team Company University College Hospital Committee Association Foundation Ministry".split()
_THING = "Act Regulations Law Prize Award Medal Scholarship Fellowship Library Building House Hall Room Theatre Wing Lecture Theorem Theory Method Principle Effect Scale Test Report Review Inquiry Plan Fund Cup Trophy Bridge Gallery Gardens Collection Reef Park School Hospital Centre Oration Precinct".split()
_ROLES = "manager|director|project officer|chair|convenor|secretary|supervisor|coordinator|author|editor|engineer|analyst|nurse|member|president|team leader|recruiter|executive assistant|adviser|policy specialist|consultant|registrar|lecturer|chief scientist|planner".split("|")
_PRODUCTS = "Microsoft Excel|Adobe Acrobat|Google Maps|Power Point|Visual Studio|Oracle Financials|Apple Pay|Linux Kernel|Windows Server|Lotus Notes|Tableau Desktop|Outlook Calendar".split("|")
_LABELS = "Manager|Project lead|Author|Prepared by|Attn|Signed|Approved by|Recruiter|Hiring manager|Enquiries|Name|Referee|Chair|Convenor|Editor|Our man on site|Media|Owner|Requested by|Witness|Next of kin|Host|Speaker|Supervisor|Nurse in charge".split("|")
_OBJECT = "Ring|Call|Ask|See|Email|Thank|Speak to|Talk with|Meet|Follow|Forward it to|Refer to|Check with|Ask for|Look for|Text|Wait for|Go to|Invite|Get in touch with|Direct all calls to|Have a word with|Message|Leave a note for|Hand it to|Phone|Book through|Get hold of|Address letters to".split("|")
_SUBJECT = (
    "will be happy to help|can answer most things|wrote the first draft|has read the minutes|is away until then|takes over next month|heads the desk|joined in {y}|signed for it|looks after this one|"
    "would like to hear from you|knows the building well|retired in {y}|did not reply|spoke at length|can tell you more|oversees {n}|was born in {y}|edits the newsletter|lives nearby|has left us|gave evidence|thinks otherwise"
).split("|")
_NOUNS = "letter plan book draft form budget map bridge survey garden meeting roster boat contract audit lesson song engine report ticket parcel ledger shift garage garden network lease claim".split()
_ID_LABELS = (
    "TFN|tax file number|tax file no|Medicare|Medicare number|Medicare card|Medicare card no.|AGS|AGS number|AGS no.|passport|passport no.|passport number|travel document|travel document no.|payroll no.|payroll number|payroll ID|"
    "employee ID|employee no.|employee number|staff number|staff ID|staff no.|service number|personnel number|licence no.|driver licence|driver licence no.|driver's licence number|driver's licence|CRN|customer reference number|member number"
).split("|")
_NUMBER_LABELS = (
    "ABN|ACN|position number|position no.|vacancy no.|notice|notice no.|file|file number|record|reference|ref.|invoice|invoice no.|order|purchase order|contract no.|room|page|form|clause|asset|asset tag|"
    "cost centre|tender|case|ticket|serial number|version|ISBN|batch|item|account code|job number|project code|receipt|barcode|grant|policy no.|parcel|lot number|chapter|week|build|meter"
).split("|")


class Maker:
    """Makes lines: parts of text, each with its kind or None. ``vocabulary``: common words to fill with,
    ``capitals``: words written with a capital only, of which people, places and bodies are named alike."""

    def __init__(self, seed: int, vocabulary: list[str], capitals: list[str]):
        self.r, self.vocabulary, self.rare, self.capitals = random.Random(seed), vocabulary[:6000], vocabulary, capitals
        self.forms: list[Callable[[], list[Part]]] = [getattr(self, n) for n in sorted(dir(self)) if n.startswith(("with_", "without_"))]
        self.weights = [3 if f.__name__ in ("with_object", "without_numbers", "without_body", "without_thing") else 1 for f in self.forms]

    # ------------------------------------------------------------ pieces
    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def filler(self, least: int = 1, most: int = 5) -> str:
        """Common words in a row, the frequent ones more often."""
        return " ".join(self.vocabulary[int(len(self.vocabulary) * self.r.random() ** 3)] for _ in range(self.r.randint(least, most)))

    def noun(self) -> str:
        return self.r.choice([self.r.choice(_NOUNS), self.vocabulary[int(len(self.vocabulary) * self.r.random())]])

    def capital(self) -> str:
        """A common word with a capital, now and then in a rarer form."""
        word = self.vocabulary[int(len(self.vocabulary) * self.r.random())]
        roll = self.r.random()
        return (word + self.r.choice(["s", "s", "ing", "er", "ers", "less", "ship"]) if roll < 0.25 else self.r.choice(self.rare) if roll < 0.45 else word).capitalize()

    def proper(self) -> str:
        return self.capitals[int(len(self.capitals) * self.r.random() ** 2)]

    def surname(self) -> str:
        r = self.r
        made = lambda: (r.choice(_HEADS) + r.choice(_TAILS)).capitalize()
        roll = r.random()
        name = r.choice(_PLAIN) if roll < 0.2 else r.choice(_FAMILY) if 0.4 < roll < 0.6 else self.proper() if 0.6 < roll < 0.7 else made()
        if 0.2 < roll < 0.27:
            name += "-" + made()
        elif 0.2 < roll < 0.32:
            name = r.choice(["O’", "O'", "D’", "Mc", "Mac"]) + made()
        elif 0.2 < roll < 0.38:
            name = r.choice(["de ", "van ", "von ", "di ", "al "]) + made()
        return name

    def given(self) -> str:
        made = (self.r.choice(_HEADS) + self.r.choice(["a", "o", "el", "in", "ka", "is", "en", "ya", "mir"])).capitalize()
        return self.r.choice([self.r.choice(_GIVEN), self.r.choice(_GIVEN), made])

    def name(self) -> str:
        r, given, family = self.r, self.given(), self.surname()
        if r.random() < 0.12 and " " not in family:
            family = family.upper()
        if r.random() < 0.05:
            given, family = given.upper(), family.upper()
        initial, form = r.choice("ABCDEFGHIJKLMNOPRSTVWYZ"), r.random()
        if form < 0.5:
            return f"{given} {family}"
        if form < 0.62:
            return f"{given[0]}. {family}"
        if form < 0.7:
            return f"{given} {initial}. {family}"
        if form < 0.78:
            return f"{given} {initial} {family}"
        if form < 0.82:
            return f"{given} {self.given()} {family}"
        return f"{family}, {given}" if form < 0.95 else f"{family}, {given[0]}."

    def who(self) -> list[Part]:
        title = self.r.choice(["", "", "", "Mr ", "Ms ", "Dr ", "Prof. ", "Mrs ", "Mx ", "Professor ", "Miss "])
        return [(title, None), (self.name(), "NAME")]

    def phone(self) -> Part:
        r = self.r
        s = r.choice([" ", " ", "-", ".", ""])
        area, a, b = r.choice("2378"), self.digits(4), self.digits(4)
        m1, m2, m3 = "4" + self.digits(2), self.digits(3), self.digits(3)
        return r.choice([
            f"0{area}{s}{a}{s}{b}", f"(0{area}) {a} {b}", f"(0{area}){s}{a}{s}{b}", f"+61 {area} {a} {b}", f"+61 (0){area} {a}-{b}", f"0011 61 {area} {a} {b}", f"0{m1}{s}{m2}{s}{m3}", f"0{m1} {m2} {m3}",
            f"+61 {m1} {m2} {m3}", f"{r.choice(['1300', '1800'])}{s}{m2}{s}{m3}", f"{a} {b}", f"{a} {b}", f"0{area}{a}{b}", f"13 {self.digits(2)} {self.digits(2)}",
        ]), "PHONE"

    def mail(self) -> Part:
        r = self.r
        user = r.choice([f"{r.choice(_GIVEN)}.{self.surname()}", f"{r.choice(_GIVEN)[0]}{self.surname()}", "jobs", "recruitment", "hr-team", "info", f"{self.surname()}.{r.choice('abc')}+jobs", f"{r.choice(_GIVEN)}_{self.surname()}{self.digits(1)}"])
        user = re.sub(r"[^A-Za-z0-9._+-]", "", user)
        user = r.choice([user.lower(), user.lower(), user, user.upper()])
        host = [r.choice(["mail", "gov", "jobs", "office"]), self.noun(), r.choice(["example", "test", "com", "org.au", "gov.au"])][r.randint(0, 1) :]
        at, dot = r.choice([("@", "."), ("@", "."), ("@", "."), (" @ ", "."), (" (at) ", " dot "), (" [at] ", " (dot) "), (" at ", " dot "), (" at ", " (dot) "), (" [at] ", " dot ")])
        return user + at + dot.join(".".join(host).split(".")), "EMAIL"

    def identity(self) -> list[Part]:
        """A label of a person's number and the number."""
        r, d = self.r, self.digits
        s, label = r.choice([" ", "-", "", " "]), r.choice(_ID_LABELS)
        low = label.lower()
        if low.startswith(("tfn", "tax")):
            number = f"{d(3)}{s}{d(3)}{s}{d(3)}"
        elif low.startswith("medicare"):
            number = r.choice([f"{d(4)} {d(5)} {d(1)}", d(10), f"{d(4)}-{d(5)}-{d(1)}"])
        elif low.startswith(("passport", "travel")):
            number = r.choice(["PA", "N", "RX", "PX", "E", "RQ", "L"]) + d(7)
        elif low.startswith("ags"):
            number = r.choice([f"{d(4)} {d(4)}", d(8)])
        elif "licence" in low:
            number = r.choice([f"{d(4)} {d(4)}", d(8), d(9), f"{d(3)} {d(3)} {d(3)}"])
        elif low.startswith(("crn", "customer")):
            number = r.choice([f"{d(3)} {d(3)} {d(3)}", d(9)])
        else:
            number = r.choice([r.choice(["S-", "K/", "", "E", "T"]) + d(6), d(7), d(6), d(8)])
        return [(label + r.choice([" ", ": ", " ", " is ", " - "]), None), (number, "ID_NUMBER")]

    def town(self) -> str:
        r, stem = self.r, self.r.choice([self.proper(), (self.r.choice(_HEADS) + self.r.choice(_TAILS)).capitalize(), (self.r.choice(_HEADS) + self.r.choice(_TAILS)).capitalize()])
        roll = r.random()
        return stem if roll < 0.3 else f"{stem} {r.choice(_TOWN_ENDS)}" if roll < 0.65 else f"{r.choice(_TOWN_STARTS)} {stem}" if roll < 0.9 else f"{r.choice(_TOWN_STARTS)} {stem} {r.choice(_TOWN_ENDS)}"

    def address(self) -> Part:
        r, d = self.r, self.digits
        number = str(r.randint(1, 299)) + r.choice(["", "", "", "A", "B"])
        lead = r.choice(["", "", "", f"Unit {r.randint(1, 30)}/", f"{r.randint(1, 30)}/", f"Level {r.randint(1, 30)}, ", "Lot ", f"Suite {r.randint(1, 30)}, "])
        name = r.choice([self.capital(), self.surname().split(" ")[-1].capitalize(), f"{self.capital()} {self.capital()}", self.given()])
        street = f"{lead}{number} {name} {r.choice(_KINDS_OF_STREET)}"
        body = r.choice([street, street, street, f"PO Box {d(4)}", f"GPO Box {d(3)}", f"Locked Bag {d(4)}", f"P.O. Box {d(4)}", f"Private Bag {d(2)}"])
        state = r.choice(_STATES)
        return body + r.choice([", ", ", ", " "]) + self.town() + r.choice(["", f" {state}", f" {state} {d(4)}", f" {state} {d(4)}", f", {state} {d(4)}"]), "ADDRESS"

    def body(self) -> str:
        r, caps = self.r, [self.proper() if self.r.random() < 0.1 else self.capital() for _ in range(4)]
        return r.choice([
            f"{r.choice(_BODY)} of {caps[0]}", f"{r.choice(_BODY)} of {caps[0]} and {caps[1]}", f"{r.choice(_BODY)} of {caps[0]}, {caps[1]} and {caps[2]}", f"{caps[0]} {r.choice(_BODY)}", f"{caps[0]} and {caps[1]} {r.choice(_BODY)}",
            f"{caps[0]} {caps[1]} {r.choice(_BODY)}", f"{caps[0]}, {caps[1]} and {caps[2]} {r.choice(_BODY)}", f"{self.town()} {r.choice(_BODY)}", f"{r.choice(_BODY)} for {caps[0]} {caps[1]}", f"{r.choice(_BODY)} of {caps[0]}, {caps[1]} and {caps[2]}", f"{r.choice(_BODY)} for {caps[0]}, {caps[1]}, {caps[2]} and {caps[3]}", f"{self.surname()} {r.choice(['Group', 'Pty Ltd', 'University', 'College'])}",
        ])

    def part(self) -> str:
        return f"{self.r.choice([self.capital(), f'{self.capital()} and {self.capital()}', f'{self.capital()} {self.capital()}'])} {self.r.choice(_BODY)}"

    def long_phone(self) -> Part:
        """A number that is known for a telephone's without a word that says so."""
        while len(re.sub(r"\D", "", (found := self.phone())[0])) < 9:
            pass
        return found

    def way(self) -> list[Part]:
        """How somebody is reached, after a name."""
        r = self.r
        short = (f"{self.digits(4)} {self.digits(4)}", "PHONE")
        return r.choice([
            lambda: [(r.choice([" on ", " (", ", ", ": ", " - ", " – ", f" {self.filler(1, 2)}: "]), None), r.choice([short, self.phone()]), (r.choice(["", "", "; ", ", "]), None)],
            lambda: [(r.choice([" on ", ", ", " - ", f" {self.filler(2, 4)}: ", f" {self.filler(1, 3)} on "]), None), short, *r.choice([[("", None)], [(r.choice(["; ", ", ", " or "]) + r.choice(["", f"{self.filler(1, 2)} "]), None), self.mail()]])],
            lambda: [(r.choice([" on ", " (", ", ", " at ", ": ", " - ", ", tel. ", ", phone ", " by mobile ", ", mob. ", " ph ", " | "]), None), self.phone()],
            lambda: [(r.choice([" at ", ", ", " (", " via ", ": ", " <", " - ", ", email "]), None), self.mail()],
            lambda: [(r.choice([" on ", ", ", " ("]), None), self.phone(), (r.choice([" or ", ", ", " / ", " and "]), None), self.mail()],
            lambda: [("", None)], lambda: [("", None)],
        ])()

    def clause(self) -> str:
        return self.r.choice([f" {self.filler(2, 6)}", f" about the {self.noun()}", f" before {self.filler(1, 3)}", f", as {self.filler(2, 4)}", f" once the {self.noun()} is {self.filler(1, 2)}", ""])

    def stop(self) -> Part:
        return self.r.choice([".", ".", ".", "", "!", ";"]), None

    # ------------------------------------------------------------ lines with something personal
    def with_object(self) -> list[Part]:
        lead = self.r.choice(["", "", f"{self.filler(1, 4).capitalize()} ", f"{self.filler(1, 3).capitalize()}, ", "Please ", f"For {self.noun()}s, ", f"Any {self.noun()}? "])
        verb = self.r.choice(_OBJECT)
        return [(lead + (verb if not lead or lead.endswith("? ") else verb[0].lower() + verb[1:]) + " ", None), *self.who(), *self.way(), (self.clause(), None), self.stop()]

    def with_label(self) -> list[Part]:
        return [(self.r.choice(_LABELS) + self.r.choice([": ", " - ", " – ", ", ", " ", " | ", ":\t"]), None), *self.who(), *self.way(), self.stop()]

    def with_role_label(self) -> list[Part]:
        title = self.r.choice([f"{self.capital()} {self.r.choice(_ROLES).title()}", self.r.choice(_ROLES).title(), self.r.choice(_ROLES).capitalize()])
        return [(title + self.r.choice([": ", " - ", " – ", " ", ", "]), None), *self.who(), *self.way(), self.stop()]

    def with_subject(self) -> list[Part]:
        lead = self.r.choice(["", "", "", f"{self.filler(1, 3).capitalize()}, ", f"{self.filler(2, 4).capitalize()} and "])
        verb = self.r.choice(_SUBJECT).format(y=self.r.randint(1950, 2025), n=self.filler(1, 3))
        return [(lead, None), *self.who(), *self.r.choice([self.way(), [("", None)]]), (f" {verb}{self.clause()}", None), self.stop()]

    def with_role_then_name(self) -> list[Part]:
        return [(f"{self.r.choice(['The', 'Our', 'Your', 'This'])} {self.r.choice(['', self.filler(1, 1) + ' '])}{self.r.choice(_ROLES)}{self.r.choice([' is ', ', ', ' ', ' was '])}", None), *self.who(), *self.r.choice([self.way(), [(f" {self.filler(1, 4)}", None)]]), self.stop()]

    def with_name_then_role(self) -> list[Part]:
        role = self.r.choice([self.r.choice(_ROLES), self.r.choice(_ROLES).title(), f"{self.capital()} {self.r.choice(_ROLES).title()}", f"{self.r.choice(['Acting', 'Deputy', 'Assistant', 'Senior'])} {self.r.choice(_ROLES).title()}"])
        bullet = self.r.choice(["", "", "- ", "• ", "* "])
        return [(bullet, None), *self.who(), (self.r.choice([", ", " (", " - ", " | "]) + role + self.r.choice(["", ")", ","]), None), *self.r.choice([self.way(), [(", ", None), self.address()], [(f" {self.filler(1, 4)}", None)]]), self.stop()]

    def with_agent(self) -> list[Part]:
        return [(f"The {self.noun()} {self.r.choice(['was', 'is', 'will be'])} {self.filler(1, 2)} by ", None), *self.who(), *self.r.choice([[("", None)], [(" and ", None), *self.who()]]), (self.clause(), None), self.stop()]

    def with_list(self) -> list[Part]:
        return [(self.r.choice(["", "Present: ", f"{self.filler(1, 3).capitalize()} "]), None), *self.who(), (self.r.choice([", ", "; "]), None), *self.who(), (self.r.choice([" and ", ", ", " & "]), None), *self.who(), (f" {self.filler(1, 5)}", None), self.stop()]

    def with_pair(self) -> list[Part]:
        return [(self.r.choice(["", f"{self.filler(1, 3).capitalize()} ", "Both "]), None), *self.who(), (self.r.choice([" and ", " or ", " with ", " & "]), None), *self.who(), (f" {self.filler(1, 6)}", None), self.stop()]

    def with_owner(self) -> list[Part]:
        return [(self.r.choice(["", f"{self.filler(1, 3).capitalize()} "]), None), *self.who(), (f"{self.r.choice(['’s', chr(39) + 's'])} {self.noun()} {self.filler(1, 4)}", None), self.stop()]

    def with_signature(self) -> list[Part]:
        return [(self.r.choice(["Regards, ", "Yours, ", "Many thanks, ", "Kind regards ", "", "- ", "Sincerely, "]), None), *self.who(), *self.way()]

    def with_name_and_number(self) -> list[Part]:
        return [(self.r.choice(["", f"{self.filler(1, 3).capitalize()} ", "The file of "]), None), *self.who(), (self.r.choice([", ", " (", " with ", ", holder of ", "; "]), None), *self.identity(), (self.r.choice([")", ",", ""]) + f" {self.filler(1, 4)}", None), self.stop()]

    def with_number(self) -> list[Part]:
        return [(self.r.choice([f"{self.filler(1, 4).capitalize()} ", "Your ", "Her ", "My ", "State the ", ""]), None), *self.identity(), (self.r.choice(["", f" {self.filler(1, 4)}", f", {self.filler(1, 3)}"]), None), self.stop()]

    def with_number_and_mail(self) -> list[Part]:
        return [(f"{self.filler(1, 4).capitalize()} ", None), *self.identity(), (self.r.choice([" to ", " or ", ", then "]), None), self.mail(), self.stop()]

    def with_mail(self) -> list[Part]:
        return [(self.r.choice([f"{self.filler(1, 4).capitalize()} ", "Email: ", "E-mail ", "Mailbox ", f"{self.filler(1, 3).capitalize()}? ", ""]), None), self.mail(), (self.clause(), None), self.stop()]

    def with_two_mails(self) -> list[Part]:
        return [(f"{self.filler(1, 4).capitalize()} ", None), self.mail(), (self.r.choice([" and ", ", ", "; ", " or "]), None), self.mail(), self.stop()]

    def with_phone(self) -> list[Part]:
        label = self.r.choice(["", "", "Phone: ", "Tel ", "Fax ", "Mobile: ", f"{self.filler(1, 2).capitalize()} hotline ", "Call ", "Ring ", "T: ", "Helpline ", "Phone us on "])
        return [(label or f"{self.filler(1, 3).capitalize()} ", None), self.r.choice([self.phone(), (f"{self.digits(4)} {self.digits(4)}", "PHONE")]) if label else self.long_phone(), (self.clause(), None), self.stop()]

    def with_two_phones(self) -> list[Part]:
        return [(self.r.choice(["Phone ", "Call ", f"{self.filler(1, 3).capitalize()} on ", "Ring "]), None), self.phone(), (self.r.choice([" or ", ", ", " / ", " and "]), None), self.phone(), self.stop()]

    def with_address(self) -> list[Part]:
        return [(self.r.choice([f"{self.filler(1, 4).capitalize()} ", "Address: ", "Location - ", f"{self.filler(1, 3).capitalize()} at ", "Send it to ", f"The {self.noun()} is at ", f"{self.filler(1, 3).capitalize()} near ", ""]), None), self.address(), (self.r.choice(["", "", f", {self.filler(1, 4)}", f" {self.filler(1, 3)}", f" ({self.filler(1, 2)})"]), None), self.stop()]

    def with_address_and_name(self) -> list[Part]:
        return [(f"{self.filler(1, 3).capitalize()} ", None), self.address(), (self.r.choice([", care of ", ", attention ", " and ask for ", " - ", ", "]), None), *self.who(), self.stop()]

    def with_name_and_address(self) -> list[Part]:
        return [(self.r.choice(["", f"{self.filler(1, 3).capitalize()} "]), None), *self.who(), (self.r.choice([" at ", ", ", " of ", f" and {self.filler(1, 3)} at "]), None), self.address(), *self.r.choice([[("", None)], [(", ", None), self.long_phone()]]), self.stop()]

    def with_name_anywhere(self) -> list[Part]:
        return [(f"{self.filler(1, 6).capitalize()} ", None), *self.who(), (f"{self.r.choice([' ', ' ', ', '])}{self.filler(1, 6)}", None), self.stop()]

    def with_body_and_name(self) -> list[Part]:
        return [(self.r.choice([f"The {self.body()} ", f"{self.body()}: ", f"{self.part()} - "]) + self.r.choice(["", f"{self.filler(1, 3)} "]), None), *self.who(), *self.way(), self.stop()]

    def with_capitals(self) -> list[Part]:
        piece, kind = self.r.choice([self.long_phone, self.mail])()
        return [(self.filler(2, 5).upper() + " ", None), (piece.upper(), kind), (f" {self.filler(1, 4).upper()}", None), self.stop()]

    # ------------------------------------------------------------ lines with nothing personal
    def without_body(self) -> list[Part]:
        return [(f"{self.r.choice(['The ', '', f'{self.filler(1, 4).capitalize()} the '])}{self.body()} {self.filler(2, 6)}{self.r.choice(['', f' the {self.part()}', f' {self.body()}'])}", None), self.stop()]

    def without_body_alone(self) -> list[Part]:
        return [(self.r.choice([self.body(), self.part(), f"{self.body()} - {self.part()}", f"{self.body()}, {self.part()}", f"{self.body()} ({self.part()})"]), None), self.r.choice([self.stop(), ("", None)])]

    def without_place(self) -> list[Part]:
        return [(f"{self.filler(1, 4).capitalize()} {self.r.choice(['in', 'from', 'to', 'near', 'at', 'between', 'through'])} {self.town()}{self.r.choice(['', f' and {self.town()}', f', {self.town()}', f' {self.r.choice(_STATES)}'])}{self.clause()}", None), self.stop()]

    def without_street(self) -> list[Part]:
        return [(f"{self.r.choice(['The ', f'{self.filler(1, 3).capitalize()} '])}{self.r.choice([self.surname(), self.capital(), f'{self.given()} {self.surname()}'])} {self.r.choice(_KINDS_OF_STREET)} {self.filler(1, 5)}{self.r.choice(['', f' in {self.r.randint(1950, 2030)}'])}", None), self.stop()]

    def without_thing(self) -> list[Part]:
        named = self.r.choice([self.surname(), f"{self.given()} {self.surname()}", f"{self.given()[0]}. {self.surname()}", f"{self.surname()}-{self.surname()}", self.surname() + self.r.choice(["’s", "'s"]), f"{self.given()} {self.surname()} Memorial"])
        return [(f"{self.r.choice(['The ', 'the ', f'{self.filler(1, 4).capitalize()} the ', f'{self.filler(1, 3).capitalize()} ', 'A '])}{named} {self.r.choice(_THING)}{self.r.choice(['', f' {self.r.randint(1950, 2025)}'])} {self.filler(1, 5)}", None), self.stop()]

    def without_thing_after(self) -> list[Part]:
        return [(f"{self.filler(1, 3).capitalize()} {self.r.choice(['at', 'in', 'under', 'for', 'from', 'near', 'into', 'of'])} the {self.r.choice([self.surname(), f'{self.given()} {self.surname()}'])} {self.r.choice(_THING)}{self.clause()}", None), self.stop()]

    def without_post(self) -> list[Part]:
        post = self.r.choice([f"{self.r.choice(['Senior', 'Acting', 'Deputy', 'Assistant', 'Principal', 'Chief', 'Junior'])} {self.capital()} {self.r.choice(_ROLES).title()}", f"{self.capital()} {self.r.choice(_ROLES).title()}", self.r.choice(_ROLES).title()])
        return [(f"{self.r.choice(['', 'The ', 'A ', 'Our ', f'{self.filler(1, 3).capitalize()} '])}{post} {self.filler(1, 5)}{self.r.choice(['', f' to the {self.r.choice(_ROLES).title()}'])}", None), self.stop()]

    def without_heading(self) -> list[Part]:
        return [(" ".join(w.capitalize() for w in self.filler(2, 7).split()) + self.r.choice(["", ":", "?"]), None)]

    def without_small_letters(self) -> list[Part]:
        return [(self.r.choice([self.filler(3, 12), f"{self.filler(1, 4)} {self.body()} {self.filler(1, 4)}", f"{self.filler(1, 3)} {self.r.choice(_ROLES)} {self.filler(1, 5)}"]).upper(), None), self.stop()]

    def without_days(self) -> list[Part]:
        days = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()
        months = "January February March April May June July August September October November December".split()
        return [(f"{self.filler(1, 4).capitalize()} {self.r.choice(days)}, {self.r.randint(1, 28)} {self.r.choice(months)} {self.r.randint(1990, 2030)}{self.clause()}", None), self.stop()]

    def without_product(self) -> list[Part]:
        return [(f"{self.filler(1, 4).capitalize()} {self.r.choice(_PRODUCTS)}{self.r.choice(['', f' and {self.r.choice(_PRODUCTS)}', f' {self.r.randint(2, 20)}'])} {self.filler(1, 4)}", None), self.stop()]

    def without_title_case_inside(self) -> list[Part]:
        phrase = " ".join(self.capital() for _ in range(self.r.randint(2, 4)))
        return [(f"{self.filler(1, 5).capitalize()} {self.r.choice(['', 'the ', 'our ', 'a '])}{phrase} {self.filler(1, 5)}", None), self.stop()]

    def without_title_case_first(self) -> list[Part]:
        return [(f"{self.capital()} {self.r.choice([self.capital(), self.town()])}{self.r.choice([' ', ', ', ': '])}{self.filler(1, 6)}", None), self.stop()]

    def without_numbers(self) -> list[Part]:
        r, d = self.r, self.digits
        number = r.choice([d(8), f"{d(4)} {d(4)}", f"{d(3)} {d(3)} {d(3)}", f"{d(2)} {d(3)} {d(3)} {d(3)}", d(r.randint(4, 10)), f"{r.randint(1990, 2030)}/{d(5)}-{d(3)}", f"{r.choice(['VN', 'A', 'PO', 'B'])}-{d(r.randint(4, 8))}", f"{d(2)}-{d(4)}", f"{r.choice('ABCNPR')}{d(r.randint(5, 8))}"])
        return [(f"{r.choice(['', f'{self.filler(1, 4).capitalize()} ', 'Our ', 'The ', 'Quote '])}{r.choice(_NUMBER_LABELS)}{r.choice([' ', ': ', ' ', ' is ', ' - '])}{number}{self.clause()}", None), self.stop()]

    def without_two_numbers(self) -> list[Part]:
        r, d = self.r, self.digits
        return [(f"{self.filler(1, 2).capitalize()} {r.choice(_NUMBER_LABELS)} {d(r.randint(4, 8))}{r.choice([' and ', ', '])}{r.choice(_NUMBER_LABELS)} {r.choice([d(8), f'{d(4)} {d(4)}', f'{d(3)} {d(3)} {d(3)}'])} {self.filler(1, 4)}", None), self.stop()]

    def without_counts(self) -> list[Part]:
        r, d = self.r, self.digits
        count = r.choice([f"{d(3)} {d(3)} {d(3)}", f"{d(4)} {d(4)}", d(6), d(7), f"{d(1)},{d(3)},{d(3)}", f"{d(2)} {d(3)}", f"${d(2)},{d(3)}", f"{d(2)}.{d(5)}", f"{d(2)} {d(3)} {d(3)}"])
        return [(f"{self.filler(1, 4).capitalize()} {count} {self.filler(1, 3)}{r.choice(['', f' from {r.randint(1950, 2000)}-{r.randint(2001, 2030)}', f' in {r.randint(1950, 2030)} to {r.randint(1950, 2030)}', f' and {d(6)} {self.filler(1, 2)}'])}", None), self.stop()]

    def without_web(self) -> list[Part]:
        low = self.surname().lower().replace(" ", "").replace("’", "").replace("'", "")
        return [(f"{self.filler(1, 4).capitalize()} {self.r.choice([f'www.{low}.example/{self.noun()}?id={self.digits(6)}', f'https://{low}.gov.au/{self.noun()}/{self.digits(8)}', f'@{low}{self.noun()}', f'#{self.capital()}{self.capital()}', f'{low}.example'])} {self.filler(1, 4)}", None), self.stop()]

    def without_names(self) -> list[Part]:
        return [(f"{self.filler(3, 10).capitalize()}{self.r.choice(['', f' {self.capital()} {self.filler(1, 4)}', f' {self.surname()} {self.filler(1, 3)}'])}", None), self.stop()]

    def line(self) -> tuple[list[Part], int]:
        """A line and the number of its form; a bullet goes before some."""
        k = self.r.choices(range(len(self.forms)), self.weights)[0]
        made = self.forms[k]()
        if self.r.random() < 0.12:
            made = [(self.r.choice(["• ", "* ", "- ", ">> ", "1. "]), None), *made]
        return [p for p in made if p[0]], k


def example_lines(count: int, seed: int, ranks: dict[str, tuple[float, float]]) -> list[tuple[str, list[tuple[int, int, str]], int]]:
    """``count`` lines with their marked spans ``(start, end, kind)`` and the number of their form."""
    maker, out = Maker(seed, common_words(ranks), capital_words(ranks)), []
    for _ in range(count):
        line, spans = "", []
        parts, form = maker.line()
        for text, kind in parts:
            if kind:
                spans.append((len(line), len(line) + len(text), kind))
            line += text
        out.append((line, spans, form))
    return out
