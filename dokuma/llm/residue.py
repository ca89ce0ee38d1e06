"""Problem 9: template residue, filler, error pages and script notices.

Lines are normalised (folded, digits as 0) and counted by host over all documents. The counts decide in two ways. Lines that recur in at least ``RECURS``
documents of a host are its boilerplate and are subtracted, unless they carry strong evidence: a notice is one on every page. And short lines about
pages, players or programs (``TOPIC``) that no pattern knows are evidence where the same line stands in at least ``TEMPLATE`` documents of several hosts: notices
come from templates, prose doesn't repeat word for word.

A document is excluded if its residual holds strong evidence, or if nothing but weak evidence is left of it: reference numbers, server
names, bare fragments of messages.

Evidence is judged sentence by sentence, filler over whole lines too. A sentence that talks about such things or quotes them (``TALK``) is none.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import DIGITS, WORD, channel_names
from ..operators.skew import hot_split_join
from ..session import materialize, spread
from .folding import fold
from .gate import literals

RECURS, TEMPLATE = 20, 3
STRONG, WEAK, TOPICAL, NONE = 3, 2, 1, 0

# Fixed values, all in folded form (lower case, plain letters).
# Words of talk about placeholders and messages: anywhere in a sentence, or close to a slot.
TALK = re.compile(
    r"\b(diye|diyen|diyerek|diyor\w*|dedi|dediler|demis|denen|denir|denilen|isaretini\w*|isaretiyle|isareti|yazisini\w*|yazisi|anlatiyor|ogrenmek isteyen|kelimesini\w*|sozcugun\w*|ifadesini\w*|uyarisini\w*|uyarilarin\w*|mesajini\w*|"
    r"said|says|called|explained|explains|asked|wrote)\b|\bthe (?:word|phrase|sign|message) ['\"‘’“”]"
)
NEAR = re.compile(r"\bsablon(?:da|daki|un)\b.{0,20}$|['\"‘“]$")
AFTER = re.compile(r"^\W{0,3}(?:\s?\w+){0,1}\s?(?:diye|diyen|denen|denilen|isaret\w*|yazisi\w*|kelimesi\w*|sozcug\w*|ifadesi\w*|sembol\w*|degiskeni\w*)\b")
# Words in braces or brackets that are stage marks.
STAGE = re.compile(r"^(alkis\w*|gulus\w*|gulme\w*|kahkaha\w*|muzik\w*|sessiz\w*|fisilti\w*|oksuru\w*|applause|laugh\w*|music|silence|nefes|alkislar)$")
HTML = frozenset("a b i u p br hr em li ol ul td th tr h1 h2 h3 div img pre sub sup span code strong small table".split())
FIELD = r"[a-z_][\w.\-]*"
SLOT = re.compile(
    r"\{\{[^{}\n]{0,60}\}\}|\{%[^%\n]{0,80}%\}|<%[^%\n]{0,80}%>|\$\{\s*[^{}\n]{0,60}\}|#\{\s*[^{}\n]{0,60}\}|\[\[\s*" + FIELD + r"\s*\]\]|\(\(\s*" + FIELD + r"\s*\)\)|@@\s*" + FIELD + r"\s*@@|"
    r"(?<!\w)__" + FIELD + r"?__(?!\w)|\$" + FIELD + r"\$|%\(\s*\w+\s*\)[sd]|(?<![\w%])%[sd](?!\w)|(?<![\w%])%" + FIELD + r"%(?!\w)|\[object\s+object\]|\{\d{1,2}\}"
)
BRACE = re.compile(r"\{\s*(" + FIELD + r")\s*\}")
ANGLE = re.compile(r"<\s*/?\s*(" + FIELD + r")\s*/?>")
ASKING = re.compile(
    r"[<\[{(«]\s*(?:[^<>\[\]{}()«»\n]{0,60}\b)?(?:buraya|girin|giriniz|yaziniz|yazin|ekleyin|ekleyiniz|doldurun|doldurunuz|insert|your|placeholder|enter|here|title here|tbd|todo)\b[^<>\[\]{}()«»\n]{0,60}[>\]})»]|"
    r"«\s*(?:…|\.{2,3})\s*[^»\n]{0,40}?(?:…|\.{2,3})\s*»"
)
BARE = re.compile(r"(?<![\w'\"‘’“”])(undefined|nan|null)(?![\w'\"‘’“”])")
BARE_SLOT = re.compile(r"^(?:\W*)(?:undefined|nan|null)\s*(?:,|adli\b)|\b(?:merhaba|ve|seslendiren|okuyan|bolum|sure|tarihi|yazar|hello|hi|dear|by|and)\b\W*\s(?:undefined|nan|null)(?!\w)|(?:^|[:·|–-]\s*)(?:undefined|nan|null)\s*(?:$|[·|,–-])")

UNFILLED = re.compile(
    r"^buraya\b.{0,60}\b(gelecek|gelecektir|eklenecek|eklenecektir|yazilacak|yaziniz|girilecek)\b|\b(aciklama|metin|baslik|icerik|ozet|tanitim|bilgi|ad|adi|gorsel)\w* (eklenecek|eklenecektir|girilecek|yazilacak|gelecek|doldurulacak)\b|"
    r"^bu (alan|bolum|kisim|metin)\w* (doldurulacak|doldurulacaktir|daha sonra doldurulacak|yer tutucu|degistirin|bos birakil)\w*|\bornek (paragraf|metin|yazi|icerik|baslik)\b.{0,60}\b(degistir|sil)\w*|yer tutucu (metin|metni|yazi)|"
    r"\byour (description|text|title|content|name|message) (goes )?here\b|\b(insert|add|enter) (your )?(text|title|description|name|content) here\b|\(\s*(todo|tbd|fixme)\s*\)|^(todo|tbd|fixme)\s*[:.!]?\s*$|^(todo|fixme)\s*:|this is (a )?(placeholder|sample|dummy) (text|paragraph)|\bplaceholder text\b|coming soon\W*$|"
    r"^(click|tap) (here )?to (add|edit) (text|title)|\b(icerik|icerigi|metin|metni|aciklama|aciklamasi|ozet|ozeti|baslik|basligi|tanitim|tanitimi) henuz (girilmedi|girilmemis\w*|eklenmedi|eklenmemis\w*|yazilmadi|yazilmamis\w*|hazir degil|hazirlanmadi)\b|^(content|description|text) (not yet available|to be added|to follow|pending)\b"
)
CODE = r"(?:40[0-9]|41[0-9]|42[0-9]|451|50[0-9]|511|52[0-9]|0)"
NAMES = r"(?:bad request|unauthorized|forbidden|not found|method not allowed|request timeout|request time-?out|gone|too many requests|internal server error|not implemented|bad gateway|service unavailable|gateway time-?out|service temporarily unavailable)"
SCRIPT = r"(?:java ?script\w*|js|betik\w*|script\w*|scripts|cerez\w*|cookie\w*)"
MESSAGE = re.compile(
    # codes
    r"^(?:http )?(?:error |hata |status |durum )?(?:kodu |code )?:?\s*\(?[45]\d\d\)?\s*[:–-]?\s*" + NAMES + r"\b|^" + NAMES + r"\s*\(?\s*[45]\d\d|^(?:hata|error|http error|http hatasi|error code|hata kodu)\s*[:#]?\s*[45]\d\d\W*$|\bhttp (?:error |hatasi |status )?[45]\d\d\b|"
    r"\bpage not found\b|^(?:oops|ops|uzgunuz)\W.{0,30}\b(?:not found|bulunamadi)\b|error establishing a (?:database|redis)|^(?:php )?(?:fatal|parse) error\s*:|^(?:php )?(?:warning|notice)\s*: .{0,80} on line \d|\buncaught (?:type|reference|syntax|range)?(?:error|exception)\b|traceback \(most recent call last\)|^(?:\w+\.)*\w+(?:error|exception)\s*:|\bon line \d+\W*$|"
    r"stack trace\s*:|segmentation fault|out of memory error|core dumped|"
    # pages, Turkish
    r"^(?:aradiginiz|istediginiz|ulasmaya calistiginiz|goruntulemek istediginiz|bu|ilgili)\s+(?:\w+\s+){0,2}(?:sayfa|icerik|video|kayit|bolum|yayin|dosya|adres|baglanti|site|oynatma listesi)\w*\b.{0,60}\b(?:bulunamadi|bulunamiyor|kullanilamiyor|goruntulenemiyor|calismiyor|mevcut degil|kaldirildi|kaldirilmis\w*|silindi|silinmis\w*|tasinmis\w*|yayinda degil|erisilemiyor|acilamadi|acilamiyor|oynatilamiyor|yuklenemedi)\b|"
    r"^(?:sayfa|icerik|video|kayit|bolum|dosya|yayin)\w*\s+(?:bulunamadi|bulunamiyor|kullanilamiyor|goruntulenemiyor|yuklenemedi|yuklenemiyor|silinmis|silindi|kaldirildi|kaldirilmis)\b|^goruntulenecek (?:icerik|kayit|sonuc) (?:yok|bulunamadi)|"
    r"^(?:bu )?(?:sayfa|site|icerik)\w*\s+(?:\w+\s+){0,3}(?:yetkiniz|izniniz|erisim izniniz) (?:yok|bulunm)|^erisim\w* (?:engellendi|reddedildi|kisitlandi|izniniz yok)|\bgoruntuleme yetkiniz yok\b|^yetkisiz erisim|"
    r"^(?:ana sayfaya|anasayfaya)\b.{0,30}\b(?:donun|tiklayin|donebilirsiniz)|^sunucu\w*\s+(?:su anda |gecici olarak )?(?:yanit|cevap)\s+ver\w*(?:miyor|medi|emiyor|emedi)\b|^sunucu\w*\s+(?:hatasi|mesgul|bakimda|kullanilamiyor|baglanilamadi|ulasilamiyor)|^sunucuya\s+(?:baglanilam|ulasilam|erisilem)\w+|"
    r"^(?:baglanti|istek|oturum)\w*\s+(?:zaman asimina ugradi|kurulamadi|kesildi|reddedildi|sonlandirildi|basarisiz)|^(?:bir|bi) (?:seyler|sey) (?:ters|yanlis) gitti|^(?:uzgunuz|ozur dileriz)?\W*(?:beklenmeyen|beklenmedik|bilinmeyen|dahili|teknik)?\s*(?:bir )?(?:beklenmeyen |beklenmedik |bilinmeyen |teknik )?(?:bir )?(?:hata|sorun|ariza) (?:olustu|meydana geldi|yasandi|yasaniyor)|"
    r"^(?:lutfen )?(?:biraz bekleyip|biraz sonra|birazdan|daha sonra|bir sure sonra|birkac dakika sonra) (?:tekrar|yeniden) (?:deneyin|deneyiniz)|^oturum\w*\s+(?:suresi\s+)?(?:doldu|sona erdi|dolmustur|kapandi)|^oturumunuzun suresi|^cok fazla (?:istek|deneme|hatali giris)|^(?:robot|insan) (?:olmadiginizi|oldugunuzu) (?:dogrula|kanitla|onayla)\w+|"
    r"^(?:site|sitemiz|sayfa|sayfamiz|sistem|sistemimiz|web sitesi|web sitemiz)\w*\s+(?:su anda |su an |gecici olarak |planli )?(?:bakimda\w*|bakim (?:calismasi|nedeniyle)|yapim asamasinda\w*|kapali\w*|guncelleniyor|hizmet dis\w*|kullanim dis\w*)|^(?:planli )?bakim (?:calismasi|nedeniyle)|^kisa sure(?:ligine)? (?:sonra )?(?:buradayiz|kapaliyiz)|^kayit silinmis|"
    r"^(?:oynatici|player|video|ses|medya|icerik|sayfa|eklenti)\w*\s+(?:yuklenemedi|yuklenemiyor|baslatilamadi|oynatilamadi|oynatilamiyor|acilamadi|desteklenmiyor)|^yukleniyor\W*(?:lutfen bekleyin\W*)?$|^(?:gecersiz|hatali) (?:istek|adres|baglanti|parametre)\W*$|^veri ?tabani\w*\s+(?:baglanti|hata)|^veri ?tabanina baglan\w+|"
    # pages, other languages
    r"^(?:error\W+)?access (?:denied|forbidden)|^you (?:do not|don.t) have (?:permission|access)|\brequested (?:url|page|resource)\b.{0,40}\b(?:not found|could not be found|does not exist)|^(?:we.re |we are )?sorry\W+(?:but )?(?:something went wrong|an error|the page|this page|we couldn|we can|that page|this content)|^(?:oops\W+)?something went wrong|^an? (?:unexpected |unknown |internal )?error (?:has )?occurred|"
    r"^(?:please )?try again later|^this (?:page|site|video|content|website|app|file|item|resource)\b.{0,30}\b(?:isn.t|is not|is no longer|can.t|cannot|could not|has been removed|has been deleted|unavailable|not available|is temporarily)|^(?:the )?(?:page|content|video) (?:you|that you)\b.{0,40}\b(?:not|moved|removed|exist)|^(?:your )?(?:session|connection) (?:has )?(?:expired|timed out|was reset|refused)|"
    r"^(?:checking|verify|verifying) (?:that )?(?:your browser|you are (?:a )?human|you.re (?:not )?)|^(?:the )?(?:site|website|server) is (?:currently |temporarily )?(?:down|under maintenance|unavailable|undergoing)|^(?:we are |we.re )?(?:currently )?(?:down for|under|undergoing) (?:scheduled )?maintenance|^are you (?:a robot|human)|^database (?:connection )?error|^(?:the )?server (?:is not responding|encountered|could not)|"
    r"^page introuvable|^acces (?:refuse|interdit)|^une erreur|^seite (?:wurde )?nicht gefunden|^zugriff verweigert|^ein fehler ist|^pagina no encontrada|^acceso denegado|^pagina non trovata"
)
NOTICE = re.compile(
    r"\b" + SCRIPT + r"\b.{0,60}\b(?:gerek\w*|sart\w*|zorunlu\w*|etkinlestir\w*|devre ?disi\w*|kapali\w*|izin ver\w*|destekle(?:miyor|mez|nmiyor)\w*|acin|acip|aciniz|calistir\w*|yuklen(?:ir|iyor|emedi)\w*|olmadan|aktif\w*|required|disabled|enabled|is off|turned off|not supported|to (?:continue|run|view|work|work properly|use|see|play))\b|"
    r"\b(?:gerek\w*|etkinlestir\w*|enable|enabling|activate|turn on|allow|requires?|without|needs?|support)\b.{0,40}\b" + SCRIPT + r"\b|^noscript\b|^js devre|\bturn it on and reload\b|^(?:acip|etkinlestirip) sayfayi yenileyin|^(?:sayfayi )?(?:acip |etkinlestirip )?(?:sayfayi )?yenileyin\W*$|"
    r"\bautoriser (?:les )?scripts\b|\b(?:activer|activez) (?:le )?javascript\b|\bjavascript (?:zu )?aktivier\w*|\baktivieren sie (?:bitte )?javascript\b|\bjavascript (?:est|ist) (?:desactive|deaktiviert|requis|erforderlich)\b|\b(?:habilite|active|activa|habilita|activar) javascript\b|\btarayici\w*\b.{0,60}\b(?:desteklemiyor|guncelleyin|izin ver\w*)"
)
FRAGMENT = re.compile(
    r"^(?:nginx|apache|cloudflare|iis|varnish|lighttpd|openresty)(?:/[\d.]+)?\W*$|^(?:ref|ref no|request id|ray id|olay no|hata no|islem no|incident|trace id|error id|event id|reference)\b\W*[0-9a-f\-]{3,}\W*$|^" + NAMES + r"\W*$|^(?:hata|error)\W*$|^[45]\d\d\W*$|^(?:lutfen )?(?:tekrar|yeniden) (?:deneyin|giris yapin)\W*$|"
    r"^yonetici bilgilendirildi\W*$|^(?:geri don|ana sayfa|anasayfa|home|back|retry|yenile)\W*$|^at [\w.$<>]+\(.*\)$|^file \".*\", line \d+.*$"
)
# Words of the usual dummy Latin.
LATIN = frozenset(
    "lorem ipsum dolor sit amet consectetur consec tetur adipiscing adipisicing elit sed eiusmod tempor incididunt labore dolore magna aliqua enim minim veniam quis nostrud exercitation ullamco laboris nisi aliquip commodo consequat duis aute irure "
    "reprehenderit voluptate velit esse cillum fugiat nulla pariatur excepteur sint occaecat cupidatat proident sunt culpa officia deserunt mollit anim laborum augue dictum felis ligula mollis nibh porta quidem sapien sodales urna vero vitae "
    "pellentesque vestibulum curabitur vivamus mauris morbi praesent suspendisse fusce donec aenean phasellus maecenas nullam nunc proin ultrices ultricies tincidunt tristique turpis tellus vehicula venenatis volutpat viverra vulputate pulvinar "
    "posuere pretium purus rhoncus rutrum sagittis scelerisque semper sollicitudin sociosqu fringilla gravida hendrerit iaculis imperdiet interdum lacinia lacus laoreet lectus leo libero lobortis luctus malesuada massa mattis metus molestie "
    "neque nisl odio orci ornare pharetra placerat porttitor dapibus diam dignissim dui efficitur egestas eleifend elementum erat eros euismod facilisis faucibus fermentum feugiat finibus accumsan aliquam ante arcu auctor bibendum blandit condimentum congue convallis cras cursus".split()
)
DUMMY = frozenset("deneme test testing asdf asd qwer qwerty zxcv jkl xxx blah foo bar baz metin baslik ornek yazi icerik paragraf dummy sample text title aaa bla".split())
PATTERNS = (SLOT, ASKING, BRACE, ANGLE, BARE, UNFILLED, MESSAGE, NOTICE, FRAGMENT)
# Stems of words about pages, players, programs and access to them. A short line with several of them, at least a fourth of its words, may be a notice that no pattern knows; counts decide.
TOPIC = (
    "sayfa site sunucu tarayici betik javascript script cerez cookie hata error page server browser erisim access oturum session baglanti connection request bakim maintenance yukle loading izniniz yetki permission denied login retry reload "
    "kullanilam bulunam goruntule unavailable available oynatici player eklenti plugin http captcha robot dogrula verify veritabani database timeout guncelle update tikla click desteklen support etkinles enable disable devre hizmet service yonetici admin sistem system"
).split()
SHORT = 16  # words
# Literals of the patterns that prose is full of, by what the patterns ask for around them: status codes, a percent sign before a name or bracket, a word of its own (``OWN``; a time that ``LEAD`` cuts off may stand before it).
NARROWED = {"nan": [], "4": [f"4{i:02}" for i in range(100)], "5": [f"5{i:02}" for i in range(100)], "%": [f"%{x}" for x in "abcdefghijklmnopqrstuvwxyz_("]}
# What any sentence with evidence holds, unless it has words of filler: found by one automaton in one pass.
HINTS = sorted(frozenset().union({"lorem"}, *map(literals, PATTERNS), *NARROWED.values()) - NARROWED.keys())
FILL = LATIN | DUMMY
LEAD = re.compile(r"^(?:[\s>»⚠*•·#=~|:\-–—]+|\[x\]|\[\s*[!x]\s*\]|\(?\d{1,2}:\d{2}(?::\d{2})?\)?)+\s*")
TAIL = re.compile(r"\s*[\(\[](?:\d{1,2}:\d{2}(?::\d{2})?|\d{1,2}\.\d{1,2}\.\d{4}|[\s,;/-])+[\)\]]\s*$")
SENTENCE = re.compile(r"(?<=[.!?…;])\s+")
SPACES = re.compile(r"\s+")


def longest(ws: list[str], like) -> list[str]:  # noqa: ANN001
    """The longest run of words for which ``like`` holds."""
    best: list[str] = []
    run: list[str] = []
    for w in ws:
        run = [*run, w] if like(w) else []
        if len(run) > len(best):
            best = run
    return best


def filler(ws: list[str]) -> bool:
    """Dummy Latin, key mashing or dummy words over and over, alone or before other text."""
    real = [w for w in ws if not w.isdigit()]
    if len(real) < 3 or all(w not in LATIN and w not in DUMMY and w[0] != "x" for w in real):
        return False
    latin = sum(w in LATIN for w in real)
    if len(real) >= 4 and latin >= 0.7 * len(real) or {"lorem", "ipsum"} <= set(real) and latin >= 0.5 * len(real) or latin >= 6 and len(longest(real, LATIN.__contains__)) >= 6:
        return True
    mashed = longest(real, lambda w: w in DUMMY or set(w) == {"x"})
    return len(mashed) >= 3 and (len(set(mashed)) < len(mashed) or all(set(w) == {"x"} for w in mashed))


def told(s: str, m: re.Match) -> bool:
    """Whether the text around a slot talks about it."""
    return bool(NEAR.search(s[max(0, m.start() - 40) : m.start()]) or AFTER.match(s[m.end() : m.end() + 45]))


def placeholder(s: str) -> bool:
    for m in SLOT.finditer(s):
        if not told(s, m):
            return True
    for m in ASKING.finditer(s):
        if not told(s, m):
            return True
    for m in BRACE.finditer(s):
        if not STAGE.match(m[1]) and not told(s, m):
            return True
    for m in ANGLE.finditer(s):
        if m[1] not in HTML and not STAGE.match(m[1]) and not told(s, m):
            return True
    return bool(BARE.search(s) and BARE_SLOT.search(s) and not TALK.search(s))


def judge(sentence: str) -> int:
    """Evidence of one folded sentence."""
    s = TAIL.sub("", LEAD.sub("", sentence)).strip()
    if not s:
        return NONE
    if placeholder(s):
        return STRONG
    if TALK.search(s):
        return NONE
    if UNFILLED.search(s) or MESSAGE.search(s) or NOTICE.search(s) or filler(WORD.findall(s)):
        return STRONG
    return WEAK if FRAGMENT.search(s) else NONE


HINT, FILLS, TOPICS, OWN = 1, 2, 4, 8


class Judge:
    """Evidence of lines. One automaton finds the hints, words of filler and topic words of a line in one pass; sentences with neither a hint nor two words of filler
    (``filler`` asks for three, of which ``LEAD`` may cut one free, or for lorem, a hint) can't have evidence and are passed over."""

    def __init__(self) -> None:
        import ahocorasick

        kinds: dict[str, int] = {}
        for kind, texts in ((HINT, HINTS), (FILLS, [*FILL, "x"]), (TOPICS, TOPIC), (OWN, ["nan"])):
            for x in texts:
                kinds[x] = kinds.get(x, 0) | kind
        self.known = ahocorasick.Automaton()
        for x, kind in kinds.items():
            self.known.add_word(x, (kind, len(x)))
        self.known.make_automaton()

    def marks(self, s: str) -> tuple[list[int], list[int], set[int]]:
        """Where hints and words of filler end, and which topic stems words begin with."""
        hints, fills, topics = [], [], set()
        for end, (kind, n) in self.known.iter(s):
            if kind & HINT:
                hints.append(end)
            elif kind & OWN and not (end >= n and s[end - n].isalpha()) and not s[end + 1 : end + 2].isalnum():
                hints.append(end)
            if kind & (FILLS | TOPICS) and (end < n or not s[end - n].isalnum()):
                if kind & TOPICS:
                    topics.add(s[end + 1 - n : end + 1])
                if kind & FILLS:
                    after = end + 1
                    while n == 1 and s[after : after + 1] == "x":
                        after += 1
                    if not s[after : after + 1].isalnum():
                        fills.append(end)
        return hints, fills, topics

    def hinted(self, s: str) -> bool:
        hints, fills, _ = self.marks(s)
        return bool(hints) or len(fills) >= 2

    def line(self, line: str) -> int:
        """Strong if any sentence is, weak if all are at least weak, topical if the line is a short one about pages and programs."""
        hints, fills, topics = self.marks(line)
        found = NONE
        if hints or len(fills) >= 2:
            ends = [m.start() for m in SENTENCE.finditer(line)]
            parts = SENTENCE.split(line)
            filled = Counter(bisect_left(ends, e + 1) for e in fills)
            marked = {bisect_left(ends, e + 1) for e in hints} | {i for i, n in filled.items() if n >= 2}
            each = {i: judge(parts[i]) for i in marked}
            if STRONG in each.values() or len(parts) > 1 and len(fills) > 2 and filler(WORD.findall(line)) and not TALK.search(line):
                return STRONG
            if all(each.get(i) == WEAK for i, x in enumerate(parts) if x.strip()):
                found = WEAK
        if not found and len(topics) >= 2 and len(WORD.findall(line)) <= min(SHORT, 4 * len(topics)) and not TALK.search(line):
            return TOPICAL
        return found


def line_evidence(docs: DataFrame) -> DataFrame:
    """One row per line with words or signs: doc_id, host, 128-bit key of the normalised line, evidence. Null hosts are one host."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge_line = Judge().line
        for b in batches:
            at, keys, kind = [], bytearray(), []
            for i, t in enumerate(b.column(2).to_pylist()):
                if t is None:
                    continue
                for line in fold(t).split("\n"):
                    line = " ".join(line.split())
                    if line:
                        at.append(i)
                        keys += xxhash.xxh3_128_digest(DIGITS.sub("0", line))
                        kind.append(judge_line(line))
            if not at:
                continue
            k = np.frombuffer(bytes(keys), np.int64).reshape(-1, 2)
            host = pc.fill_null(channel_names(b.column(1)), "")
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at)), host.take(pa.array(at)), pa.array(k[:, 0]), pa.array(k[:, 1]), pa.array(kind, pa.int32())], ["doc_id", "host", "k1", "k2", "evidence"])

    kind = dict(docs.dtypes)["doc_id"]
    return spread(docs.select("doc_id", "source", "text").filter("doc_id is not null")).mapInArrow(run, f"doc_id {kind}, host string, k1 long, k2 long, evidence int")


KEY = ["host", "k1", "k2"]


def residue(docs: DataFrame, recurs: int = RECURS, template: int = TEMPLATE) -> DataFrame:
    """(doc_id, n_strong, n_weak, n_left, n_boilerplate) of each document with evidence in its residual. ``n_strong`` counts lines of strong evidence and those that
    recur as templates do, ``n_weak`` lines of weak evidence, ``n_left`` the lines left of the document. Repeated rows of a document count once a line;
    null and blank texts have no lines and are none of them."""
    lines = materialize(line_evidence(docs), "lines")
    by_doc = lines.groupBy(*KEY, "doc_id").agg(F.max("evidence").alias("evidence"), F.count("*").alias("rows"))
    # Lines that occur once and say nothing are most of all; they decide nothing and end here.
    counted = by_doc.groupBy(*KEY).agg(F.count("*").alias("n"), F.sum("rows").alias("rows"), F.max("evidence").alias("evidence"))
    counted = materialize(counted.filter((F.col("evidence") == TOPICAL) | ((F.col("evidence") < STRONG) & (F.col("n") >= recurs))), "counted")
    templates = counted.filter(F.col("evidence") == TOPICAL).groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.count("*").alias("hosts"), F.sum("rows").alias("rows"))
    templates = materialize(templates.filter((F.col("n") >= template) & (F.col("hosts") >= 2)).select("k1", "k2", "rows"), "templates")
    common = counted.filter(F.col("n") >= recurs).join(templates.select("k1", "k2"), ["k1", "k2"], "left_anti").select(*KEY, "rows")
    weak, strong = (F.col("evidence") == WEAK).cast("long"), (F.col("evidence") == STRONG).cast("long")
    suspects = lines.groupBy("doc_id").agg(F.count("*").alias("all"), F.sum(strong).alias("strong"), F.sum(weak).alias("weak"), F.max("evidence").alias("most")).filter(F.col("most") > NONE)
    gone = hot_split_join(lines.filter(F.col("evidence") < STRONG), materialize(common, "common"), KEY, "rows").groupBy("doc_id").agg(F.count("*").alias("gone"), F.sum(weak).alias("gone_weak"))
    raised = hot_split_join(lines.filter(F.col("evidence") == TOPICAL).select("doc_id", "k1", "k2"), templates, ["k1", "k2"], "rows").groupBy("doc_id").agg(F.count("*").alias("raised"))
    j = suspects.join(gone, "doc_id", "left").join(raised, "doc_id", "left").na.fill(0, ["gone", "gone_weak", "raised"])
    n_strong, n_weak, left = F.col("strong") + F.col("raised"), F.col("weak") - F.col("gone_weak"), F.col("all") - F.col("gone")
    return j.filter((n_strong > 0) | ((F.col("weak") > 0) & (n_weak == left))).select("doc_id", n_strong.alias("n_strong"), n_weak.alias("n_weak"), left.alias("n_left"), F.col("gone").alias("n_boilerplate"))
