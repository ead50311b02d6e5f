"""License scans: whole texts looked up by the digest of their canonical form.

The canonical form has A-Z lower-cased, copyright lines and comment signs
removed, punctuation and white space as single breaks between words, and
equivalent spellings made equal. Two texts with the same form are the same
licence text, so one equi-join on a SHA-256 digest finds them all, whatever the
number of known licences.

Defined results: null and empty texts, and those of copyright lines only, have
the digest of the empty text and no licence; repeated rows are scanned alike;
other columns pass through unless their names are those of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logsync.llm.url_filter import LOWER, UPPER

# So many known licences are broadcast: a digest and a name each.
BROADCAST_LICENSES = 200_000
RESULT = ("license_digest", "license_id")

# Spellings that count as equal, the second replacing the first.
EQUIVALENTS = (
    ("acknowledgment", "acknowledgement"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("centre", "center"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgment", "judgement"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licenced", "licensed"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("non  commercial", "noncommercial"),
    ("per  cent", "percent"),
    ("sub  license", "sublicense"),
    ("copyright  holder", "copyright  owner"),
    ("copyright  holders", "copyright  owners"),
)

_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
    " software and associated documentation files (the \"Software\"), to deal in the Software"
    " without restriction, including without limitation the rights to use, copy, modify, merge,"
    " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
    " to whom the Software is furnished to do so, subject to the following conditions:\n"
    "The above copyright notice and this permission notice shall be included in all copies or"
    " substantial portions of the Software.\n"
)
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
    " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
    " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE"
    " FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR"
    " OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE."
)
_ISC_TERMS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO"
    " THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT"
    " SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR"
    " ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION"
    " OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE"
    " USE OR PERFORMANCE OF THIS SOFTWARE."
)
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of"
    " conditions and the following disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of"
    " conditions and the following disclaimer in the documentation and/or other materials"
    " provided with the distribution.\n"
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used"
    " to endorse or promote products derived from this software without specific prior written"
    " permission.\n"
)
_BSD_TAIL = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY"
    " EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE"
    " COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,"
    " EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF"
    " SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION)"
    " HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR"
    " TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS"
    " SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
    " without fee is hereby granted"
)
# Texts of known licences, and the one-line statements in use.
KNOWN = (
    ("MIT", "MIT License\n" + _PERMISSION + _AS_IS),
    ("MIT", _PERMISSION + _AS_IS),
    ("MIT", "The MIT License (MIT)\n" + _PERMISSION + _AS_IS),
    ("MIT", "Released under the MIT License."),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL),
    ("BSD-2-Clause", "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_TAIL),
    ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("BSD-3-Clause", "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    (
        "ISC",
        _ISC_GRANT + ", provided that the above copyright notice and this permission notice"
        " appear in all copies.\n" + _ISC_TERMS,
    ),
    ("0BSD", _ISC_GRANT + ".\n" + _ISC_TERMS),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this"
        " file except in compliance with the License. You may obtain a copy of the License at\n"
        "http://www.apache.org/licenses/LICENSE-2.0\n"
        "Unless required by applicable law or agreed to in writing, software distributed under"
        " the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF"
        " ANY KIND, either express or implied. See the License for the specific language"
        " governing permissions and limitations under the License.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
)


# Wrapped licence texts have lines that begin with the word but are no notice.
_NOTICE = (
    r"copyright(?![ \t\r]*(\n|$))"
    r"(?![ \t]+(notices?|holders?|owners?|licen[sc]es?|laws?|statements?|and|or|in|to)([^a-z]|$))"
)


def canonical(text: Column) -> Column:
    """Words between double blanks, so that neighbours can be replaced alike."""
    low = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    kept = F.regexp_replace(
        low, rf"(^|\n)[ \t#*/;%\-]*({_NOTICE}|\(c\)|©|all rights reserved)[^\n]*", "\n"
    )
    words = F.regexp_replace(kept, r"[^a-z0-9\x{80}-\x{10FFFF}]+", "  ")
    out = F.concat(F.lit(" "), F.trim(words), F.lit(" "))
    for spelling, usual in EQUIVALENTS:
        out = F.replace(out, F.lit(f" {spelling} "), F.lit(f" {usual} "))
    return out


def license_digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known_licenses(spark: SparkSession) -> DataFrame:
    """The texts of ``KNOWN`` as ``license_id, text``."""
    return spark.createDataFrame(list(KNOWN), "license_id string, text string")


def scan_licenses(docs: DataFrame, known: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``license_digest`` and ``license_id`` (NULL: not a known text).

    Of known texts that share a digest the smallest id counts.
    """
    digests = (
        known.select(license_digest(F.col("text")).alias("license_digest"), "license_id")
        .where((F.col("license_digest") != license_digest(F.lit(""))) & F.col("license_id").isNotNull())
        .groupBy("license_digest")
        .agg(F.min("license_id").alias("license_id"))
    )
    small = digests.limit(BROADCAST_LICENSES + 1).count() <= BROADCAST_LICENSES
    scanned = docs.drop(*(c for c in RESULT if c in docs.columns)).withColumn(
        "license_digest", license_digest(F.col(text))
    )
    kept = [scanned[c] for c in scanned.columns]
    found = F.broadcast(digests) if small else digests
    return scanned.join(found, scanned["license_digest"] == found["license_digest"], "left").select(
        *kept, found["license_id"]
    )
