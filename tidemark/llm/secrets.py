"""Secret scan: base patterns plus dictionary-primed zstandard novelty.

Base kinds are patterns with a fixed meaning (``assign``, ``access``, ``hex``).
The ``novel`` kind needs no pattern of the secret itself: every token that
follows a sensitive word closely, and every value that is assigned to one, is a
candidate, also where a base span covers it, and its novelty is what it
adds to the zstandard size of the text around it.  The compressor is primed
with a dictionary of code and identifier words, and the surrounding text is in
the same frame, so ordinary names, paths and repeated words add a few bytes
while random keys add most of their length.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

#: fixed values: the base kinds, in the order that breaks ties
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 8, 16, 32
KINDS = ("assign", "access", "hex", "novel")

#: words that make what follows them sensitive, and how far they reach
SENSITIVE = ("password", "passwd", "passphrase", "pwd", "secret", "token", "api_key", "apikey", "api-key",
             "credential", "bearer", "authorization", "private_key", "private key", "access_key",
             "access key", "client_id", "signature")
NEAR = 48                # of the start of a candidate behind the word, on its line ...
REACH = 128              # ... and of one of FAR_MIN characters or more: numbers of every kind are shorter
FAR_MIN = 24
NOVEL_MIN = 16           # shortest candidate ...
VALUE_MIN = 10           # ... and shortest one that is assigned to the word
RUN = r"A-Za-z0-9+/_.~\-"   # what a candidate consists of, with '=' as trailing padding only
CONTEXT = 256            # code points of surrounding text on each side
NOVEL_BYTES = 10         # least marginal bytes ...
NOVEL_RATIO = 0.5        # ... and least marginal bytes for each byte of the candidate

#: what the compressor knows beforehand
IDENTIFIERS = (
    "the and for with from this that not are was return import def class self None True False public static void "
    "private protected final const let var function string int long double boolean null undefined new if else elif "
    "while for each switch case break continue try catch except finally raise throw throws async await yield lambda "
    "print println printf format length size append extend insert remove update delete select where group order by "
    "join left right inner outer table column index key value values name names id ids user users username email "
    "address account config configuration settings options option default environment variable variables production "
    "development staging test tests testing example examples example.com example.org example.net localhost 127.0.0.1 "
    "http:// https:// www. .com .org .net .html .json .yaml .yml .xml .txt .csv .py .js .java application/json "
    "Content-Type Accept User-Agent Authorization Bearer Basic client_id client_secret access_token refresh_token "
    "session_id request response status message error warning info debug trace timestamp created_at updated_at "
    "placeholder changeme your_password_here your-api-key-here your_token_here xxxxxxxxxxxxxxxxxxxx 0000000000000000 "
    "1234567890 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ process.env os.environ getenv "
    "getElementById querySelector addEventListener constructor prototype toString valueOf hashCode equals compareTo "
    "connection connect database host port server service services client api_key apikey api-key secret_key "
    "private_key public_key access_key password passwd passphrase secret token credential credentials signature "
)


#: a private key in armour: optional headers, whole lines (or ``\\n`` for line ends), a short last one before the end mark
_GAP = r"(?:\s|\\[nr])+"
PEM = (rf"-----BEGIN [A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?-----(?:\s|\\[nr])*(?:[A-Za-z-]+: [^\n\\]*{_GAP})*"
       rf"((?:[A-Za-z0-9+/]{{16,}}={{0,2}}{_GAP})*[A-Za-z0-9+/]{{16,}}={{0,2}}"
       rf"(?:{_GAP}[A-Za-z0-9+/=]{{1,76}}(?=(?:\s|\\[nr])*-----))*)")


def _marginal(packer: zstandard.ZstdCompressor, before: str, token: str, after: str) -> int:
    with_it = packer.compress((before + token + after).encode("utf-8"))
    without = packer.compress((before + after).encode("utf-8"))
    return len(with_it) - len(without)


class Scanner:
    """``spans(text)`` -> [(kind, start, end)], code points, end exclusive, sorted by
    start and then by kind as listed in ``KINDS``."""

    def __init__(self) -> None:
        self.assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
        self.access = re.compile(f"AKIA[A-Z0-9]{{{ACCESS_MIN - 4},}}")    # a run that is too short has no longer suffix
        self.hex = re.compile(f"[0-9a-f]{{{HEX_MIN},}}")
        words = "|".join(re.escape(w) for w in sorted(SENSITIVE, key=len, reverse=True))
        self.sensitive = re.compile(words, re.IGNORECASE | re.ASCII)
        padding = rf"(?![{RUN}=])"
        self.candidate = re.compile(rf"(?<![{RUN}])(?:[{RUN}]{{{NOVEL_MIN},}}(?:={{1,2}}{padding})?|"
                                    rf"[{RUN}]{{{NOVEL_MIN - 1}}}={{1,2}}{padding}|[{RUN}]{{{NOVEL_MIN - 2}}}=={padding})")
        self.begins = re.compile(rf"(?<![{RUN}])[{RUN}]")
        # a value right behind the word, over at most one line end, of any characters but space and quotes
        self.value = re.compile(rf"""["'\])]{{0,2}}[ \t]{{0,8}}[:=]>?[ \t]{{0,8}}(?:\r?\n[ \t]{{0,16}})?["']?([^\s"'`<>]{{{VALUE_MIN},}})""")
        self.parameter = re.compile(r"&[A-Za-z_][\w.-]*=")
        self.pem = re.compile(PEM)
        known = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.packer = zstandard.ZstdCompressor(level=9, dict_data=known, write_content_size=False,
                                               write_dict_id=False)

    def base(self, text: str, low: str) -> list[tuple[str, int, int]]:
        found = []
        if any(w in low for w in ("passw", "secret", "token", "apikey", "api_key")):
            found += [("assign", m.start(), m.end()) for m in self.assign.finditer(text)
                      if m.end(2) - m.start(2) >= ASSIGN_MIN]
        if "AKIA" in text:
            found += [("access", *m.span()) for m in self.access.finditer(text)]
        found += [("hex", *m.span()) for m in self.hex.finditer(text)]
        return found

    def adds(self, text: str, start: int, end: int) -> bool:
        """Whether the text around it does not explain a candidate."""
        added = _marginal(self.packer, text[max(0, start - CONTEXT):start], text[start:end], text[end:end + CONTEXT])
        return added >= NOVEL_BYTES and added >= NOVEL_RATIO * (end - start)

    def novel(self, text: str) -> list[tuple[str, int, int]]:
        """Candidates that the text around them does not explain.  Each is measured once, base spans
        or none; a value that begins with a measured candidate is one with it."""
        found = []
        if "PRIVATE KEY" in text:
            found += [("novel", *m.span(1)) for m in self.pem.finditer(text) if self.adds(text, *m.span(1))]
        armour, at, upto = found.copy(), 0, -1
        for word in self.sensitive.finditer(text):
            value = self.value.match(text, word.end())
            candidates = []
            if value:
                parameter = self.parameter.split(value[1], maxsplit=1)[0]      # of a URL, up to the next one
                end = value.start(1) + len(parameter.rstrip(".,;:!?)]}"))
                if end - value.start(1) >= VALUE_MIN:
                    candidates.append((value.start(1), end))
            for run in self.begins.finditer(text, word.end(), min(len(text), word.end() + REACH + 1)):
                start = run.start()
                if "\n" in text[word.end():start]:
                    break
                m = self.candidate.match(text, start)
                if m and (start - word.end() <= NEAR or m.end() - start >= FAR_MIN):
                    candidates.append((start, m.end()))
            for start, end in sorted(candidates, key=lambda c: (c[0], -c[1])):
                if start < upto:
                    continue
                while at < len(armour) and armour[at][2] <= start:
                    at += 1
                upto = end
                if (at == len(armour) or armour[at][1] >= end) and self.adds(text, start, end):
                    found.append(("novel", start, end))
        return found

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        if not text:
            return []
        low = text.lower()
        found = self.base(text, low)
        found += self.novel(text)
        return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: (doc_id, spans), spans an array of (kind, start, end)
    over the whole text.  Null and empty texts have none; a repeated row gets a
    repeated result; an empty table gives no row.  Other columns are not read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for piece in slices(batch, "t"):
                found = [[{"kind": k, "start": s, "end": e} for k, s, e in scanner.spans(t)]
                         for t in piece.column("t").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(found, kind)], ["doc_id", "spans"])
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("t"))
    return two.mapInArrow(run, "doc_id long, spans array<struct<kind:string,start:long,end:long>>")


def redact(docs: DataFrame, text_col: str = "text", mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with every span replaced by ``mask`` (overlapping spans by one mask); an
    ``n_chars`` column follows the new text.  All rows and columns stay, in place;
    null texts stay null."""
    at = docs.columns.index(text_col)
    count_at = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def clean(scanner: Scanner, text: str | None) -> str | None:
        spans = scanner.spans(text)
        if not spans:
            return text
        out, upto = [], 0
        for _, start, end in spans:
            if start >= upto:
                out += [text[upto:start], mask]
            upto = max(upto, end)
        return "".join(out) + text[upto:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            for piece in slices(batch, text_col):
                old = piece.column(at)
                new = [clean(scanner, t) for t in old.to_pylist()]
                piece = piece.set_column(at, text_col, pa.array(new, old.type))
                if count_at is not None:
                    counts = piece.column(count_at)
                    kept = [n if t is None else len(t) for t, n in zip(new, counts.to_pylist())]
                    piece = piece.set_column(count_at, "n_chars", pa.array(kept, counts.type))
                yield piece
    return docs.mapInArrow(run, docs.schema)
