"""Labelled examples on which the model of personal information is trained.

Hand-written contexts with marked places, filled by invented values:
``<N>`` person names, ``<P>`` phone numbers, ``<I>`` identity numbers, ``<E>``
e-mail addresses, ``<A>`` addresses; ``{dish}`` and the like are filled as
decoys and stay unlabelled.
"""

from __future__ import annotations

import random
import re

_NAMES = [
    "My neighbour <N> taught me to sew.", "Our neighbour <N> came over with tea.", "I met <N> who owns a small boat.", "Yesterday we met <N> at the market.", "Thanks to <N> for the quick reply!", "Thanks to <N> for all of it.",
    "According to my landlord, <N>, the rent is due.", "My doctor, <N>, said so.", "The red bike belongs to <N> now.", "It belonged to <N> before.", "Ask for <N> at the front counter.", "Please ask for <N> when you call.", "signed, <N>",
    "signed, <N> {start} the shelf near the door.", "Regards, <N>", "Best wishes, <N>", "-- <N>", "-- <N> {start} the shelf near the door.", "-- <N>\n", "Pak <N> bilang airnya sudah panas.", "Bu <N> dari rumah sebelah membawa kue.",
    "Mr <N> sold us the car.", "Mrs. <N> sold us the car.", "Dr. <N> read the chart.", "Kata <N>, obeng itu bagus.", "Menurut <N>, obeng itu bagus.", "<N> used to fix every clock in town.", "That day it rained. <N> used to fix every clock.",
    "{low} and so on. <N> wrote the first guide.", "The guide was written by <N> in spring.", '"Sudah siap," ujar <N>.', "She spoke with <N> about it.", "Hubungi <N> untuk kunci.", "My cousin <N> and I went home.", "Salam, <N>", "Interview with <N> went well.",
    "{low} signed, <N> {start} it again.", "{low} -- <N> {start} it again.", "{low} thanks to <N> for the {low}", "{low} my neighbour <N> taught me", "{low} ask for <N> at the {low} counter", "{low} kata <N>, itu bagus", "{low} Pak <N> bilang sudah", "{low} Bu <N> dari gang sebelah",
]
_NO_NAMES = [
    "{dish} and {dish2} go well with rice.", "{dish} and {dish2} beat any soup.", "Cream of {dish3} goes with bread.", "The {firm} meets on a dry day to talk.", "The {firm} opens at nine.", "Bought a {place} brand lamp for this.", "In {place} they cut the grass late.",
    "Warga {place} memilih menanam padi.", "Pihak {place} menilai harga naik.", "Petugas di {place} menyebut jalan basah.", "Reports from {place} mention rain.", "Kelompok dari {place} mulai bekerja.", "{dish} is on the menu with {dish2}.", "Try the {dish} at lunch.",
    "We flew from {place} to {place2} and back.", "{start} the pan on the stove. {start} it again.", "Menurut catatan di {place}, hujan turun.", "Nobody in {place} would paint it.", "We like {dish} more than {dish2}.", "The {firm} and the {firm} merged.", "{start} {place} needs rain.",
    "Resep {dish} dan {dish2} enak.", "Street food like {low} is never dull.", "Unpopular take: the {low} wins. {start} it.",
]
_PHONES = [
    "Call <P> before you come.", "my number is <P>, text only, no chat", "WA <P> kalau masih ada.", "Nomor <P> jangan diangkat, penipu", "Somebody at <P> sold me a chair.", "The shop answers on <P> most days.", "Tel <P>", "Tel: <P>", "<P> is the line for parts.",
    "Hubungi <P> untuk pesan.", "They rang from <P> at night.", "Phone <P> any time.", "Telepon <P> saja.", "Text me at <P> later.", "whatsapp <P> ya", "Reach the desk on <P>.", "Nomor saya <P> ya", "HP <P>",
]
_IDS = [
    "KTP: <I>", "KTP <I> hilang", "NIK saya <I> dipakai orang.", "NPWP <I> ditolak, padahal benar.", "passport no <I>, still waiting", "Passport: <I>", "Someone used <I> (my national id!) for a loan.", "They asked for my ID <I> just to rent a tent.",
    "The form shows <I> as the tax number of the shop.", "social security <I> was on the page", "SSN <I>", "My tax number is <I> now.", "nomor paspor <I> sudah lama", "Identity card <I> was lost.", "ID <I> belongs on the form.",
]
_EMAILS = ["mail: <E>", "Write to <E> today.", "cc <E> please, it is late", "PM or <E>", "(contact <E> about the job)", "Reach me at <E> if you want it.", "Sent the files to <E> on time.", "Kirim ke <E> ya.", "tulis ke <E>", "<E> never answered me.", "The list is kept by <E>, so write there."]
_ADDRESSES = [
    "Ship the box to <A> please.", "Come by <A> and bring a friend.", "We moved to <A>, so all is in a box.", "Alamat: <A>", "Rumah saya di <A>, dekat pasar.", "Pick up the tray at <A> any evening.", "From <A> it is a short walk.", "The crate was left outside <A> for a week.",
    "Barang diambil di <A> saja.", "Office: <A>", "I live at <A> now.",
]
_DECOYS = [
    "Order no. {d6} for the lamp arrived.", "Order no. {d5} for the lamp arrived.", "Serial {d7} is printed under the lid.", "Serial {d6} is printed.", "Batch {d6}-{d3} of the paint was dull.", "Batch {d5}-{d3} was fine.", "Batch {d4}-{d3} was fine.", "Model T{d3}-{d3} fits the lamp.",
    "ISBN {d3}-0-{d3}-{d3}-0 is the book.", "ISBN 978-0-{d3}-{d5}-{d1} is the book.", "Version 10.{d1}.{d1}.{d1} of the app is new.", "It was 20{d2}-05-15 when it broke.", "It was 15/05/20{d2} when it broke.", "See the chart, rows 12-34-56, column 7.",
    "the manual, edition 2019-2024, says {d3}.", "My hat cost 1.250.000 and the bag 85.000.", "Harga Rp {d3}.000, bukan Rp {d3}.500.", "Bake the tray at 350-375 for 40 minutes.", "Nomor antrean A{d3} untuk loket.", "Mix 250 ml, 1.5 kg and 3/4 cup.", "It took {d3} days and {d4} steps.",
    "Open 08:00-17:30, closed on rain.", "It scored 4.5/5 at {d4} votes.", "Flight GA{d3} left at 10:45.", "I follow the @ tag for ideas.", "We met at 10 dot sharp.", "I live two streets from the road.", "Room {d3} on floor 12.", "Invoice {d6}/{d4} was paid.", "Tracking {d9} is on its way.",
    "user {user} replied", "{user} posted it first",
]
_START = "Put Reports Bought Most Pick Keep When After Before Our Not Set Try If Jika Setelah Dalam Has Honestly Same Unpopular Call Nomor Kirim Alamat Somebody There Nobody What Come From Ship Rencana Tidak".split()
_LOW = "small lamp|paper box|old chair|stone wall|rice bowl|garden gate".split("|")
_SYLLABLES = "ba be bo da de di fa fe ga go ha ka ke la le li lo ma me mi mo na ne no pa pe pi ra re ri ro sa se so ta te ti va ve vi wa we za ze".split()
_ENDS = "n r l s nd rt lk x ng sp th mp rn".split()
_GIVEN = "Marla Tomas Ingrid Yusuf Dewi Agus Ratna Oliver Petra Anwar Lukas Sinta Budi Helena Farid Mirela Jonas Wati Edwin Clara".split()
_FAMILY = "Albrecht Santoso Marchetti Lindqvist Hidayat Okonjo Pratama Vandermeer Suharto Kowalska Nasution Ferreira Wibowo Hargreave".split()
_DISH = ["Nasi Uduk Betawi", "Green Hill Biscuits", "Red Fox Cheese", "Soto Mie Bogor", "Ayam Bakar Madu", "Black Swan Honey", "Old Barn Cookies", "Sate Lilit Bali", "Blue Lake Cream", "White Oak Jam"]
_DISH3 = ["Golden Carrot", "Wild Garlic", "Sweet Corn", "Red Lentil"]
_FIRM = ["Copper Lantern Society", "Silver Anvil Guild", "Old Harbour Club", "Green Valley Union", "Iron Bridge Company", "Rainy Day Choir"]


def _word(r: random.Random) -> str:
    return ("".join(r.choice(_SYLLABLES) for _ in range(r.choice((2, 3)))) + r.choice(_ENDS)).capitalize()


def _name(r: random.Random) -> str:
    given, family = r.choice([r.choice(_GIVEN), _word(r)]), r.choice([r.choice(_FAMILY), _word(r), _word(r)])
    form = r.random()
    if form < 0.5:
        n = f"{given} {family}"
    elif form < 0.62:
        n = f"{given} {r.choice(_GIVEN)} {family}"
    elif form < 0.74:
        n = f"{given} {r.choice('ABDEFGHJKLMNPRSTVWZ')}. {family}"
    elif form < 0.88:
        n = f"{r.choice('ABDEFGHJKLMNPRSTVWZ')}. {family}"
    else:
        n = f"{family}, {given}"
    case = r.random()
    return n.upper() if case < 0.09 else n.lower() if case < 0.2 else n


def _digits(r: random.Random, n: int, first: str = "") -> str:
    return (first + "".join(r.choice("0123456789") for _ in range(n)))[:n]


def _phone(r: random.Random) -> str:
    a, b, c, m = _digits(r, 3, str(r.randint(2, 9))), _digits(r, 3, "555"), _digits(r, 4), r.choice(("811", "812", "857", "878", "899"))
    return r.choice([
        f"{a}-{b}-{c}", f"({a}) {b}-{c}", f"{a}.{b}.{c}", f"{a}{b}{c}", f"+1 {a} {b} {c}", f"+1-{a}-{b}-{c}", f"1-{a}-{b}-{c}", f"{a} {b} {c}", f"+62 {m} {_digits(r, 4)} {c}", f"0{m}-{_digits(r, 4)}-{c}", f"0{m}{_digits(r, 4)}{c}",
        f"0{m} {_digits(r, 4)} {c}", f"62{m}{_digits(r, 4)}{c}", f"+62{m}{_digits(r, 4)}{c}", f"+62-{m}-{_digits(r, 4)}-{c}", f"(021) {_digits(r, 4)} {c}", f"021-{_digits(r, 4)}-{c}", f"(021) {_digits(r, 4)}{c}", f"+44 20 {_digits(r, 4)} {c}",
    ])


def _identity(r: random.Random) -> str:
    return r.choice([
        f"{_digits(r, 3, str(r.randint(1, 9)))}-{_digits(r, 2)}-{_digits(r, 4)}", f"{_digits(r, 3, str(r.randint(1, 9)))} {_digits(r, 2)} {_digits(r, 4)}", _digits(r, 16, str(r.randint(1, 9))), " ".join(_digits(r, 4, "3") for _ in range(4)),
        f"{_digits(r, 2)}.{_digits(r, 3)}.{_digits(r, 3)}.{_digits(r, 1)}-{_digits(r, 3)}.{_digits(r, 3)}", r.choice("ABCEXQZ") + _digits(r, 8), r.choice("ABCEXQZ") + _digits(r, 7), "-".join(_digits(r, 4, "3") for _ in range(4)),
    ])


def _email(r: random.Random) -> str:
    a, b, d = r.choice(_GIVEN).lower(), r.choice(_FAMILY).lower(), _word(r).lower()
    local = r.choice([f"{a}.{b}", f"{a}_{b}", f"{a}+{b[:4]}", f"{a}{_digits(r, 2)}", f"{b}-{a}", a])
    tail = r.choice(["example", "test", "co.example", "mail.example", "com"])
    whole = r.choice([f"{local}@{d}.{tail}"] * 4 + [f"{local}(at){d}.{tail}", f"{local} [at] {d} [dot] {tail.replace('.', ' [dot] ')}", f"{local} at {d} dot {tail.replace('.', ' dot ')}", f"{local} (at) {d} (dot) {tail.replace('.', ' (dot) ')}"])
    return whole.upper() if r.random() < 0.1 else whole


def _address(r: random.Random) -> str:
    w, v, n = _word(r), _word(r), r.randint(1, 480)
    kind = r.choice(["Street", "St.", "Road", "Avenue", "Lane", "Court", "Close", "Drive"])
    return r.choice([
        f"{n} {w} {kind}, {v}", f"{n}b {w} {kind}, {v} {_digits(r, 5)}", f"Flat {n % 30 + 1}, {n} {w} {kind}", f"Jl. {w} {v} No. {n}, {_word(r)}", f"Jalan {w} Gang {n % 9 + 1} No {n}, RT 0{n % 9}/RW 0{n % 8}", f"Jalan {w} No. {n}",
        f"Komplek {w} Blok {r.choice('ABCD')}{n % 20 + 1} No. {n % 60}", f"PO Box {n}, {w} {_digits(r, 5)}", f"{n} {w} {v} {kind}", f"Perumahan {w} Blok {r.choice('ABCD')}{n % 20 + 1} No. {n % 60}",
    ])


def ordinary() -> frozenset:
    """Words of the examples that are no part of a value."""
    return frozenset(w.lower() for w in _START) | {w for x in _LOW for w in x.split()} | {w.lower() for x in (*_NAMES, *_NO_NAMES, *_PHONES, *_IDS, *_EMAILS, *_ADDRESSES, *_DECOYS) for w in re.findall(r"(?<![<{])\b[A-Za-z]{2,}\b(?![>}])", x)}


def examples(seed: int = 11, rounds: int = 5) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """``(text, [(start, end, type)])``, starts from 0."""
    r = random.Random(seed)
    makers = {"N": (_name, "person_name"), "P": (_phone, "phone"), "I": (_identity, "id_number"), "E": (_email, "email"), "A": (_address, "address")}
    fill = {"dish": lambda: r.choice(_DISH), "dish2": lambda: r.choice(_DISH), "dish3": lambda: r.choice(_DISH3), "firm": lambda: r.choice(_FIRM), "place": lambda: _word(r), "place2": lambda: _word(r), "start": lambda: r.choice(_START), "low": lambda: r.choice(_LOW), "user": lambda: f"{_word(r).lower()}_{_digits(r, 3)}"}
    out = []
    for _ in range(rounds):
        for line in _NAMES * 2 + _NO_NAMES * 2 + _PHONES * 2 + _IDS * 2 + _EMAILS + _ADDRESSES * 2 + _DECOYS:
            if r.random() < 0.3:
                line = f"{r.choice(_START)} the {r.choice(_LOW)} away. {line}"
            if r.random() < 0.3:
                line = f"{line} {r.choice(_START)} the {r.choice(_LOW)} away."
            text, spans, at = "", [], 0
            for m in re.finditer(r"<([NPIEA])>|\{(\w+)\}", line):
                text += line[at : m.start()]
                at = m.end()
                if m[1]:
                    value = makers[m[1]][0](r)
                    spans.append((len(text), len(text) + len(value), makers[m[1]][1]))
                else:
                    value = _digits(r, int(m[2][1:]), "7") if re.fullmatch(r"d\d", m[2]) else fill[m[2]]()
                text += value
            out.append((text + line[at:], spans))
    return out
