"""Secret scan: fixed patterns, and strings that compression can't explain.

The patterns give the base spans.  Beyond them, every string that follows a
sensitive word and is no plain word or number is a candidate, and so is every
string that follows a candidate over a newline, dot, quote or other separator,
and all of a PEM block of a private key.  Its novelty is the number of bytes it
adds to a zstandard frame primed with two dictionaries: common identifiers, and
the text around it.  Words, identifiers and repeats of the context cost few
bytes; a random string costs about its entropy, and is reported.  Of one that
overlaps a base span, the rest is.

Defined results: a null or empty text has no span; repeated rows are scanned
one by one; an empty table gives no rows; whole texts are read at any length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from tillroll.llm.common import map_batches, text_docs

# The base patterns of the contract.
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "novel")

# Words that make the string after them sensitive.
SENSITIVE_WORDS = ("password", "passwd", "passphrase", "pwd", "secret", "token", "apikey", "api_key", "api-key",
                   "access_key", "access-key", "access key", "private_key", "private-key", "private key",
                   "credential", "authorization", "bearer", "signature", "client_id", "session_id", "encryption_key")
SENSITIVE = re.compile("|".join(map(re.escape, SENSITIVE_WORDS)), re.A | re.I)
REACH = 48  # characters after a sensitive word in which a candidate may begin
LEAST = 9  # characters of a candidate: a shorter one can't hold the least bytes of ``all_spans``
LONG = 16  # characters from which a string without a digit or without a letter may be a candidate
RUN = re.compile(r"[A-Za-z0-9+/_=~-]+")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=~-]{%d,}" % LEAST)
# Between two strings of a chain: separators, line ends as such or escaped; not blanks alone.
LINK = re.compile(r"(?=[^\n]*\n|[ \t]*[^\w\s])(?:\\[nrt]|(?<=\s)\+(?=\s)|[^\w+/=~-]){1,32}", re.A)
KEY_BLOCK = re.compile(r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY[A-Z ]*-----(.*?)(?:-----END|\Z)", re.S)
# A line of several words that is no header of a key.
PROSE_LINE = re.compile(r"\n(?![\w-]+: )[^\n]*?\S[ \t]+\S")

# Identifiers that code repeats.
IDENTIFIERS = """access_key_id account_name algorithm application_config argument attribute authentication
authorization_code background boolean buffer_size callback certificate_path character class_name client_identifier
collection_name column_name command_line component configuration connection_string constructor container content_type
controller controller_name current_user database_name database_password datetime default_value dependency description
destination development directory document_id element encoding endpoint_url environment_variable exception execute
expiration export_function extension file_name final_result framework function_name generator get_password_hash
github.com https://www.example.com/api/v1/users identifier implementation import_module index_name initialize_session
input_stream instance_id integer interface is_authenticated iterator javascript json_response keyword_argument language
library license listener localhost:8080 location_name logger_level max_connections message_queue metadata method_name
middleware module_name namespace navigation network_interface notification null_pointer number_of_items object_id
operation organization output_directory package_name parameter_value parent_node password_reset_token permission
pipeline_stage placeholder previous_version primary_key private_key_file process_request production_server project_id
property protocol_version public_static_void_main query_string random_string_generator reference_id refresh_token
repository_url request_handler resource_group response_body return_value runtime schedule_job schema secret_manager
security_group select_from_where sequence_number serializer server_address service_account session_timeout
settings_module signature_version source_code standard_output status_code storage_bucket string_builder structure
subscription super_user synchronize system_property table_name template_name temporary_file test_case_example
thread_pool timestamp transaction_id transform_data undefined unit_test update_password user_agent user_name utf-8
validate_input variable_name version_number virtual_machine webhook_secret window_size workspace_id your_api_key_here
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 xxxxxxxxxxxxxxxx 0000000000000000 changeme"""


class Novelty:
    """Marginal compressed bytes of a string, given identifiers and its surroundings."""

    def __init__(self, around: int = 1024, level: int = 3):
        import zstandard

        words = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=level)
        self.around = around
        self.compress = zstandard.ZstdCompressor(
            level=level, dict_data=words, write_checksum=False, write_content_size=False, write_dict_id=False).compress

    def __call__(self, text: str, start: int, end: int) -> int:
        near = (text[max(0, start - self.around):start] + " " + text[end:end + self.around // 2] + " ").encode(
            "utf-8", "surrogatepass")
        return len(self.compress(near + text[start:end].encode())) - len(self.compress(near))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns, in order of start, then kind as listed."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def mixed(word: str) -> bool:
    """Whether a string is none that prose is made of: letters with digits, long digits, or cases in disorder."""
    letters, digits = re.search("[A-Za-z]", word), re.search("[0-9]", word)
    if letters and digits:
        return True
    return len(word) >= LONG and bool(digits or len(re.findall("[a-z][A-Z]", word)) * 6 >= len(word))


class Taken:
    """The base spans, overlapping ones as one."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for _, a, b in spans:  # in order of start
            if self.ends and a <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def rest(self, start: int, end: int) -> list[tuple[int, int]]:
        """What of a string no base span covers."""
        out, at = [], start
        for i in range(bisect_right(self.ends, start), bisect_left(self.starts, end)):
            if self.starts[i] > at:
                out.append((at, self.starts[i]))
            at = self.ends[i]
        return [*out, (at, end)] if at < end else out


def novel_spans(text: str, taken, novelty: Novelty, *, least_bytes: int, least_share: float):
    """Spans of candidates in a sensitive context that cost too many bytes to be words."""
    found, done = [], set()
    low = text.lower()
    if not any(w in low for w in SENSITIVE_WORDS):
        return found
    base = Taken(taken)

    def novel(start, end):
        cost = novelty(text, start, end)
        return cost >= least_bytes and cost >= least_share * (end - start)

    def measure(start, end) -> bool:
        """Report what of a candidate is novel; whether it is a secret, as a base span or so."""
        rest = base.rest(start, end)
        if rest == [(start, end)]:
            if novel(start, end):
                found.append(("novel", start, end))
                return True
            return False
        for a, b in rest:
            # Before a base span may stand a name; what follows one belongs to the same string.
            if novel(start if a > start else a, b):
                found.append(("novel", a, b))
        return True

    def follow(start, end):
        """Measure a candidate and those that follow it."""
        secret = measure(start, end)
        while (gap := LINK.match(text, end)) and (m := RUN.match(text, gap.end())) and m.start() not in done:
            word = m[0]
            part = gap[0] == "." and secret and (mixed(word) or len(word) >= LEAST)  # of a dotted token
            if not part and (len(word) < LONG or not (secret or mixed(word))) and not (len(word) >= LEAST and mixed(word)):
                return
            done.add(m.start())
            end = m.end()
            secret = measure(m.start(), end)

    for near in SENSITIVE.finditer(text):
        at = near.end()
        while m := CANDIDATE.search(text, at, near.end() + REACH + LEAST):
            m = CANDIDATE.match(text, m.start())  # to its end, which may lie beyond
            at = m.end()
            if m.start() not in done and mixed(m[0]):
                done.add(m.start())
                follow(m.start(), at)
    for block in KEY_BLOCK.finditer(text) if "PRIVATE KEY" in text else ():
        after = False  # of a secret line, the shorter last ones are part of the key
        start, end = block.span(1)
        if end == block.end() and (prose := PROSE_LINE.search(text, start, end)):  # cut off: up to the text that goes on
            end = prose.start()
        for m in RUN.finditer(text, start, end):
            if m.start() in done:
                after = after or ("novel", *m.span()) in found[-1:] or len(m[0]) >= LONG
            elif len(m[0]) >= LONG:
                after = measure(*m.span())
            elif after and text[m.start() - 1] == "\n" and text[m.end():m.end() + 1] in ("", "\n", "\r"):  # a line of its own
                found += [("novel", a, b) for a, b in base.rest(*m.span())]
            done.add(m.start())
    return found


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans, mask: str) -> str:
    """``text`` with every span, overlapping ones as one, replaced by ``mask``."""
    out, at = [], 0
    for _, start, end in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def all_spans(text: str, novelty: Novelty, *, least_bytes: int = 9, least_share: float = 0.5):
    """(base spans, base and novel spans), each in order of start, then kind as listed."""
    base = base_spans(text)
    more = novel_spans(text, base, novelty, least_bytes=least_bytes, least_share=least_share)
    return base, sorted(base + more, key=lambda x: (x[1], KINDS.index(x[0]))) if more else base


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", least_bytes: int = 9,
                 least_share: float = 0.5) -> DataFrame:
    """(doc_id, kinds, starts, ends, base_sha256, spans) for every row of ``docs``.

    ``spans`` lists kind:start:end in code points, end exclusive; ``base_sha256``
    digests those of the fixed patterns.
    """
    fields = pa.schema([
        ("doc_id", pa.int64()), ("kinds", pa.list_(pa.string())), ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())), ("base_sha256", pa.string()), ("spans", pa.string())])

    def run(batches):
        novelty = Novelty()
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                base, spans = all_spans(text, novelty, least_bytes=least_bytes, least_share=least_share)
                rows.append(([s[0] for s in spans], [s[1] for s in spans], [s[2] for s in spans],
                             sha256(joined(base).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*rows)) or [[]] * (len(fields) - 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, f.type) for c, f in zip(columns, list(fields)[1:]))], schema=fields)

    return text_docs(docs, id_col=id_col, text_col=text_col).mapInArrow(
        run, "doc_id long, kinds array<string>, starts array<long>, ends array<long>, base_sha256 string, spans string")


def mask_secrets(docs: DataFrame, *, text_col: str = "text", length_col: str | None = None, mask: str = "[SECRET]",
                 least_bytes: int = 9, least_share: float = 0.5) -> DataFrame:
    """``docs`` with every span of its texts masked, and ``length_col``, if named, counting the new code points."""
    def change():
        novelty = Novelty()

        def step(batch, texts):
            new = [t if t is None else
                   masked(t, all_spans(t, novelty, least_bytes=least_bytes, least_share=least_share)[1], mask) for t in texts]
            columns = dict(zip(batch.schema.names, batch.columns))
            columns[text_col] = pa.array(new, pa.string())
            if length_col:
                kind = columns[length_col].type
                columns[length_col] = pa.array(
                    [n if a is b or a == b else len(b) for n, a, b in zip(columns[length_col].to_pylist(), texts, new)], kind)
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        return step

    return map_batches(docs, change, text_col=text_col)
