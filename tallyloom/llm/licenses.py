"""License scan: ordered signature rules behind a keyword gate.

A text becomes its lower-case words with single spaces between them. Texts without the
keywords of any rule are done; the gate is made from the rules, so it never closes on a text
that a rule matches. For the others each rule whose keyword occurs is matched, and every
match is a span of words. A span inside another of the same or a stronger priority is
suppressed, so a long signature outranks the short names inside it.

Rules come from two places: those written by hand (sentences, notices, versions and headers
of the GNU family, licenses by name), and names put into the forms that texts use for them.

Spans are small rows (document, rule, start, end). Their order within a document comes
from a window per document, never per rule or label, so a popular license is not a hot key.

Defined results: a null or empty text has no words and no labels; repeated rows get the
same result each; a text of any length is read whole, in one task; an empty table gives an
empty result.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import fold, let, same, text_of
from tallyloom.sources.stage import stage

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Names of licenses as they appear among words: label, keywords of which one must occur, pattern.
NAMES = (
    ("mit", (" mit ",), "(?:mit|mit x11)"),
    ("expat", (" expat",), "expat"),
    ("apache", (" apache",), "(?:the )?apache(?: software)?"),
    ("apache-2.0", (" apache",), "apache(?: license)?(?: version)? 2(?: 0)?(?! [1-9])"),
    ("gpl", (" gpl",), "(?:gnu )?gpl"),
    ("gpl-2.0", (" gpl", " general public"), "(?:gnu )?(?:gpl ?v?2(?: 0)?|(?<!lesser )(?<!library )(?<!affero )general public license(?: version)? v?2(?: 0)?)"),
    ("gpl-3.0", (" gpl", " general public"), "(?:gnu )?(?:gpl ?v?3(?: 0)?|(?<!lesser )(?<!library )(?<!affero )general public license(?: version)? v?3(?: 0)?)"),
    ("lgpl", (" lgpl", " lesser", " library"), "(?:gnu )?(?:lgpl(?: ?v?[23](?: [01])?)?|(?:lesser|library) general public)"),
    ("agpl", (" agpl", " affero"), "(?:gnu )?(?:agpl(?: ?v?3(?: 0)?)?|affero general public)"),
    ("gfdl", (" gfdl", " fdl", " free documentation"), "(?:gnu )?(?:gfdl|fdl|free documentation)"),
    ("bsd", (" bsd",), "bsd"),
    ("bsd-2-clause", (" bsd", " simplified bsd", " freebsd"), "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)"),
    ("bsd-3-clause", (" bsd",), "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd)"),
    ("0bsd", (" 0bsd",), "0bsd"),
    ("mpl", (" mpl", " mozilla"), "(?:mpl(?: 2(?: 0)?)?|mozilla public)"),
    ("epl", (" epl", " eclipse"), "(?:epl(?: 2(?: 0)?)?|eclipse public)"),
    ("eupl", (" eupl", " european"), "(?:eupl|european union public)"),
    ("cddl", (" cddl", " common development"), "(?:cddl|common development and distribution)"),
    ("isc", (" isc ",), "isc"),
    ("zlib", (" zlib",), "(?:zlib|zlib libpng)"),
    ("libpng", (" libpng",), "libpng"),
    ("boost", (" boost", " bsl "), "(?:boost(?: software)?|bsl 1 0)"),
    ("unlicense", (" unlicense",), "unlicense"),
    ("cc0", (" cc0", " creative"), "(?:cc0(?: 1 0)?|creative commons zero)"),
    ("cc-by", (" cc by", " creative"), "(?:cc by(?: [1-4] 0)?|creative commons attribution(?: [1-4] 0)?)"),
    ("cc-by-sa", (" cc by", " creative"), "(?:cc by sa(?: [1-4] 0)?|creative commons attribution share ?alike)"),
    ("cc-by-nc", (" cc by", " creative"), "(?:cc by nc(?: [1-4] 0)?|creative commons attribution non ?commercial)"),
    ("cc-by-nd", (" cc by", " creative"), "(?:cc by nd(?: [1-4] 0)?|creative commons attribution no ?deriv(?:ative)?s)"),
    ("artistic", (" artistic",), "artistic"),
    ("wtfpl", (" wtfpl", " do what"), "(?:wtfpl|do what the fuck you want to public)"),
    ("ofl", (" ofl", " sil "), "(?:ofl(?: 1 1)?|sil open font)"),
    ("ms-pl", (" ms pl", " microsoft"), "(?:ms pl|microsoft public)"),
    ("postgresql", (" postgresql",), "postgresql"),
    ("python", (" psf", " python"), "(?:psf|python software foundation)"),
    ("ruby", (" ruby",), "ruby"),
    ("php", (" php",), "php"),
    ("openssl", (" openssl",), "openssl"),
    ("vim", (" vim",), "vim"),
    ("sspl", (" sspl", " server side"), "(?:sspl|server side public)"),
    ("busl", (" busl", " business"), "(?:busl|business source)"),
    ("elastic", (" elastic",), "elastic(?: 2 0)?"),
    ("afl", (" afl", " academic"), "(?:afl|academic free)"),
    ("osl", (" osl", " open software"), "(?:osl|open software)"),
    ("odbl", (" odbl", " open database"), "(?:odbl|open database)"),
    ("ncsa", (" ncsa", " university of illinois"), "(?:ncsa|university of illinois ncsa)"),
    ("beerware", (" beer",), "beer ?ware"),
    ("tcl", (" tcl",), "tcl tk"),
    ("curl", (" curl",), "curl"),
    ("w3c", (" w3c",), "w3c"),
    ("zope", (" zpl", " zope"), "(?:zpl|zope public)"),
)
# How a name is put: keyword, pattern around the name, priority (1 is strongest), weight.
FORMS = (
    ("spdx", "spdx license identifier {}(?: only| or later)?", 1, 0.99),
    ("under", "(?:licen[cs]ed|released|distributed|published|available|provided) under (?:the )?(?:terms of (?:the )?)?{}(?: licen[cs]e)?", 2, 0.95),
    ("licen", "{} (?:software |public |free )?licen[cs]ed?(?: version [0-9]+(?: [0-9]+)?)?", 3, 0.85),
    ("licen", "licen[cs]e {}", 4, 0.6),
    ("terms", "terms of (?:the )?{}", 4, 0.6),
)
# Sentences that only one license has: label, keyword, pattern.
SENTENCES = (
    ("mit", "permission", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", "redistribut", "redistribution and use in source and binary forms"),
    ("bsd-3-clause", "endorse", "neither the name of .{1,80}? may be used to endorse or promote products"),
    ("gpl", "free software", "this program is free software you can redistribute it"),
    ("lgpl", "free software", "this library is free software you can redistribute it"),
    ("apache-2.0", "compliance", "you may not use this file except in compliance with the license"),
    ("mpl", "source code form", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("boost", "organization", "to any person or organization obtaining a copy of the software"),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("no-warranty", "warrant", "without (?:any )?warrant(?:y|ies) (?:of any kind|or conditions)"),
    ("all-rights-reserved", "rights", "all rights reserved"),
    ("proprietary", "confidential", "(?:proprietary and confidential|confidential and proprietary)"),
)

GPL = "(?:gnu )?(?:gpl|(?<!lesser )(?<!library )(?<!affero )general public licen[cs]e)"
LGPL = "(?:gnu )?(?:lgpl|(?:lesser|library) general public licen[cs]e)"
AGPL = "(?:gnu )?(?:agpl|affero general public licen[cs]e)"
VERSION = " ?(?:v ?|ver |version )?"
LATER = " (?:(?:or|and) (?:at your option )?(?:any )?later|or newer|plus)"
HEADER = " as published by the free software foundation (?:either )?version "
FAMILY = (" gpl", " lgpl", " agpl", " general public")
# Written by hand, for texts with "general public" or a short name of that family: label, pattern. Priority 2.
GNU = (
    ("gpl-1.0", GPL + " ?(?:v ?|ver |version )1(?: 0)?"),
    ("gpl-2.0", GPL + VERSION + "2(?: 0)?(?: only)?"),
    ("gpl-3.0", GPL + VERSION + "3(?: 0)?(?: only)?"),
    ("gpl-2.0-or-later", GPL + VERSION + "2(?: 0)?" + LATER),
    ("gpl-3.0-or-later", GPL + VERSION + "3(?: 0)?" + LATER),
    ("gpl-2.0", "version 2(?: 0)? of the " + GPL),
    ("gpl-3.0", "version 3(?: 0)? of the " + GPL),
    ("gpl-2.0", GPL + HEADER + "2(?: of the licen[cs]e)?"),
    ("gpl-3.0", GPL + HEADER + "3(?: of the licen[cs]e)?"),
    ("gpl-2.0-or-later", GPL + HEADER + "2(?: of the licen[cs]e)?" + LATER),
    ("gpl-3.0-or-later", GPL + HEADER + "3(?: of the licen[cs]e)?" + LATER),
    ("gpl-2.0", "gnu general public licen[cs]e version 2 june 1991"),
    ("gpl-3.0", "gnu general public licen[cs]e version 3 29 june 2007"),
    ("gpl-with-classpath-exception", GPL + "(?:" + VERSION + "[23](?: 0)?)? with (?:the )?(?:gnu )?classpath exception"),
    ("gpl-with-linking-exception", GPL + "(?:" + VERSION + "[23](?: 0)?)? with (?:a |the )?(?:runtime |gcc |linking |font )+(?:library )?exception"),
    ("lgpl-2.0", LGPL + VERSION + "2(?: 0)?(?: only)?(?! 1)"),
    ("lgpl-2.1", LGPL + VERSION + "2 1(?: only)?"),
    ("lgpl-3.0", LGPL + VERSION + "3(?: 0)?(?: only)?"),
    ("lgpl-2.0-or-later", LGPL + VERSION + "2(?: 0)?" + LATER),
    ("lgpl-2.1-or-later", LGPL + VERSION + "2 1" + LATER),
    ("lgpl-3.0-or-later", LGPL + VERSION + "3(?: 0)?" + LATER),
    ("lgpl-2.1", "version 2 1 of the " + LGPL),
    ("lgpl-3.0", "version 3(?: 0)? of the " + LGPL),
    ("lgpl-2.0-or-later", LGPL + HEADER + "2(?: of the licen[cs]e)?" + LATER),
    ("lgpl-2.1-or-later", LGPL + HEADER + "2 1(?: of the licen[cs]e)?" + LATER),
    ("lgpl-3.0-or-later", LGPL + HEADER + "3(?: of the licen[cs]e)?" + LATER),
    ("lgpl-2.1", "gnu lesser general public licen[cs]e version 2 1 february 1999"),
    ("agpl-1.0", AGPL + " ?(?:v ?|ver |version )1(?: 0)?"),
    ("agpl-3.0", AGPL + VERSION + "3(?: 0)?(?: only)?"),
    ("agpl-3.0-or-later", AGPL + VERSION + "3(?: 0)?" + LATER),
    ("agpl-3.0", "version 3(?: 0)? of the " + AGPL),
    ("agpl-3.0-or-later", AGPL + HEADER + "3(?: of the licen[cs]e)?" + LATER),
)
# Written by hand, for texts with "licen": label, keyword, pattern. Priority 2.
NAMED = (
    ("llama-community", " llama", "llama(?: [2-4](?: [0-9])?)? community licen[cs]e(?: agreement)?"),
    ("llama-community", " meta llama", "meta llama [2-4](?: [0-9])? licen[cs]e"),
    ("gemma", " gemma", "gemma licen[cs]e"),
    ("openrail", " openrail", "openrail(?: m)?(?: licen[cs]e)?"),
    ("openrail", " responsible ai", "(?:open )?responsible ai licen[cs]es?"),
    ("creativeml-openrail-m", " creativeml", "creativeml open ?rail m(?: licen[cs]e)?"),
    ("bigscience-rail", " bigscience", "bigscience (?:bloom )?(?:open ?)?rail(?: m)?(?: 1 0)?(?: licen[cs]e)?"),
    ("bigcode-openrail-m", " bigcode", "bigcode open ?rail m(?: v1)?(?: licen[cs]e)?"),
    ("falcon-llm", " falcon", "falcon(?: 180b| llm)?(?: tii)? licen[cs]e"),
    ("mistral-non-production", " mistral", "mistral (?:ai )?non production licen[cs]e"),
    ("mistral-research", " mistral", "mistral (?:ai )?research licen[cs]e"),
    ("deepseek-model", " deepseek", "deepseek (?:model )?licen[cs]e(?: agreement)?"),
    ("qwen", " qwen", "(?:tongyi )?qwen (?:research )?licen[cs]e(?: agreement)?"),
    ("stability-community", " stability", "stability(?: ai)? community licen[cs]e"),
    ("stability-non-commercial", " stability", "stability(?: ai)? non commercial (?:research )?(?:community )?licen[cs]e"),
    ("ai2-impact", " impact", "ai2 impact licen[cs]e"),
    ("nvidia-open-model", " nvidia", "nvidia open model licen[cs]e"),
    ("apple-sample-code", " apple", "apple sample code licen[cs]e"),
    ("hippocratic", " hippocratic", "hippocratic licen[cs]e(?: version)?(?: [1-3] [0-9])?"),
    ("anti-996", " 996", "anti 996 licen[cs]e"),
    ("polyform-noncommercial", " polyform", "polyform non ?commercial licen[cs]e"),
    ("polyform-small-business", " polyform", "polyform small business licen[cs]e"),
    ("polyform-shield", " polyform", "polyform shield licen[cs]e"),
    ("polyform-perimeter", " polyform", "polyform perimeter licen[cs]e"),
    ("polyform-strict", " polyform", "polyform strict licen[cs]e"),
    ("prosperity", " prosperity", "prosperity public licen[cs]e"),
    ("parity", " parity", "parity public licen[cs]e"),
    ("blue-oak", " blue oak", "blue oak model licen[cs]e"),
    ("functional-source", " functional source", "functional source licen[cs]e"),
    ("commons-clause", " commons clause", "commons clause (?:licen[cs]e )?(?:condition|restriction|licen[cs]e)"),
    ("confluent-community", " confluent", "confluent community licen[cs]e"),
    ("timescale", " timescale", "timescale licen[cs]e"),
    ("redis-source-available", " redis", "redis source available licen[cs]e"),
    ("cockroachdb-community", " cockroach", "cockroach(?:db)? community licen[cs]e"),
    ("elastic-2.0", " elastic", "elastic licen[cs]e(?: version)? (?:v ?)?2(?: 0)?"),
    ("busl-1.1", " business source", "business source licen[cs]e(?: version)? (?:v ?)?1 1"),
    ("odc-by", " open data commons", "open data commons attribution licen[cs]e"),
    ("pddl", " public domain dedication", "public domain dedication and licen[cs]e"),
    ("cdla-permissive", " community data", "community data licen[cs]e agreement permissive"),
    ("cdla-sharing", " community data", "community data licen[cs]e agreement sharing"),
    ("open-government", " open government", "open government licen[cs]e"),
    ("etalab", " etalab", "etalab(?: open)? licen[cs]e"),
    ("mit-0", " no attribution", "mit no attribution(?: licen[cs]e)?"),
    ("x11", " x11", "x11 licen[cs]e"),
    ("freetype", " freetype", "freetype (?:project )?licen[cs]e"),
    ("ijg", " jpeg", "independent jpeg group(?: s)? licen[cs]e"),
    ("icu", " icu", "icu licen[cs]e"),
    ("unicode", " unicode", "unicode (?:data files and software |terms of use |inc )?licen[cs]e(?: agreement)?(?: v3)?"),
    ("ms-rl", " reciprocal", "microsoft reciprocal licen[cs]e"),
    ("apsl", " apple", "apple public source licen[cs]e"),
    ("ipl", " ibm", "ibm public licen[cs]e"),
    ("cpl", " common public", "common public licen[cs]e"),
    ("cpal", " attribution licen", "common public attribution licen[cs]e"),
    ("qpl", " q public", "q public licen[cs]e"),
    ("sleepycat", " sleepycat", "sleepycat licen[cs]e"),
    ("lppl", " latex", "latex project public licen[cs]e"),
    ("ecl-2.0", " educational", "educational community licen[cs]e"),
    ("upl", " universal permissive", "universal permissive licen[cs]e"),
    ("mulan-psl", " mulan", "mulan (?:permissive software licen[cs]e|psl)(?: v?[12])?"),
    ("cecill", " cecill", "cecill(?: [bc])?(?: free software)? licen[cs]e"),
    ("rpl", " reciprocal", "(?<!microsoft )reciprocal public licen[cs]e"),
    ("eudatagrid", " eu datagrid", "eu datagrid software licen[cs]e"),
    ("intel-open-source", " intel", "intel open source licen[cs]e"),
    ("nasa-1.3", " nasa", "nasa open source (?:licen[cs]e )?agreement(?: version)?(?: 1 3)?"),
    ("mpl-1.1", " mozilla", "mozilla public licen[cs]e(?: version)? (?:v ?)?1 1"),
    ("mpl-2.0", " mozilla", "mozilla public licen[cs]e(?: version)? (?:v ?)?2(?: 0)?"),
    ("epl-1.0", " eclipse", "eclipse public licen[cs]e(?: version)? (?:v ?)?1(?: 0)?"),
    ("epl-2.0", " eclipse", "eclipse public licen[cs]e(?: version)? (?:v ?)?2(?: 0)?"),
    ("eupl-1.2", " european union", "european union public licen[cs]e(?: version)? (?:v ?)?1 2"),
    ("cddl-1.0", " common development", "common development and distribution licen[cs]e(?: cddl)?(?: version)? (?:v ?)?1(?: 0)?"),
    ("artistic-2.0", " artistic", "artistic licen[cs]e(?: version)? (?:v ?)?2(?: 0)?"),
    ("afl-3.0", " academic free", "academic free licen[cs]e(?: version)? (?:v ?)?3(?: 0)?"),
    ("osl-3.0", " open software", "open software licen[cs]e(?: version)? (?:v ?)?3(?: 0)?"),
    ("gfdl-1.3", " free documentation", "gnu free documentation licen[cs]e(?: version)? (?:v ?)?1 3"),
    ("apache-1.1", " apache", "apache(?: software)? licen[cs]e(?: version)? (?:v ?)?1 1"),
    ("apache-2.0", " apache", "apache licen[cs]e version 2 0 january 2004"),
    ("bsd-2-clause", " two clause", "two clause bsd(?: style)?(?: licen[cs]e)?"),
    ("bsd-3-clause", " three clause", "three clause bsd(?: style)?(?: licen[cs]e)?"),
    ("bsd-4-clause", " bsd", "(?:original bsd licen[cs]e|(?:bsd 4|4) clause(?: bsd)?(?: licen[cs]e)?)"),
    ("bsd-style", " bsd", "bsd (?:style|like|type) licen[cs]e"),
    ("mit-style", " mit ", "mit (?:style|like|type) licen[cs]e"),
    ("dual-license", " dual", "dual(?:ly)? licen[cs]ed"),
    ("commercial", " commercial", "(?:requires|under|purchase|obtain) (?:a |the )?(?:separate )?commercial licen[cs]e"),
    ("evaluation", " evaluation", "evaluation (?:licen[cs]e|purposes only)"),
    ("unlicensed", " unlicensed", "unlicensed proprietary"),
)
# Written by hand, sentences of notices: label, keyword, pattern. Priority 1.
NOTICES = (
    ("bsd-4-clause", "advertising", "all advertising materials mentioning features or use of this software must display"),
    ("mit", "permission", "the above copyright notice and this permission notice shall be included in all copies"),
    ("hpnd", "permission", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("gnu-all-permissive", "permitted in any medium", "copying and distribution of this file with or without modification are permitted in any medium"),
    ("json", "used for good", "the software shall be used for good not evil"),
    ("as-is", "warrant", "this software is provided as is without any express or implied warranty"),
    ("lgpl", "free software", "this library is free software you may copy distribute or modify it"),
    ("mit", " x11", "(?:mit x11|x11 mit)"),
    ("gemma", " gemma", "gemma terms of use"),
)


def rules() -> list[tuple[str, int, float, list[tuple[str, ...]], str, bool]]:
    """(label, priority, weight, keywords, pattern, base) of every rule, base phrases first.

    A rule is tried where one keyword of each of its tuples occurs.
    """
    out = [(label, 3, 0.9, [(phrase,)], phrase, True) for phrase, label in BASE]
    out += [(label, 1, 0.97, [(keyword,)], pattern, False) for label, keyword, pattern in SENTENCES]
    for keyword, form, priority, weight in FORMS:
        for label, keywords, name in NAMES:
            out.append((label, priority, weight, [(keyword,), keywords], form.format(name), False))
    out += [(label, 1, 0.97, [(keyword,)], pattern, False) for label, keyword, pattern in NOTICES]
    out += [(label, 2, 0.95, [FAMILY], pattern, False) for label, pattern in GNU]
    out += [(label, 2, 0.95, [("licen",), (keyword,)], pattern, False) for label, keyword, pattern in NAMED]
    for label, keywords, name in NAMES:  # names with a version or variant say enough alone
        if "-" in label:
            out.append((label, 2, 0.9, [keywords], name, False))
    return out


def gate(words: Column) -> Column:
    """Whether the keywords of some rule occur: rules with the same ones are asked once, forms with the same names together."""
    any_of = lambda keys: reduce(lambda a, k: a | k, [F.contains(words, F.lit(k)) for k in sorted(keys)])
    alone, forms = set(), {}
    for _, _, _, keywords, _, _ in rules():
        if len(keywords) == 1:
            alone.update(keywords[0])
        else:
            (form,), names = keywords
            forms.setdefault(form, set()).update(names)
    common = set.intersection(*forms.values())
    out = any_of(alone) | (any_of(forms) & any_of(common - alone))
    for form, names in sorted(forms.items()):
        if names - common - alone:
            out = out | (any_of([form]) & any_of(names - common - alone))
    return out


def as_words(text: Column) -> Column:
    return F.trim(F.regexp_replace(fold(text), SEPARATORS, " "))


def spans(texts: DataFrame) -> DataFrame:
    """(doc_id, text_hash, label, priority, weight, base, first, last) of every match, in words, last exclusive."""
    kind = "array<struct<rule int, label string, priority int, weight double, keywords array<array<string>>, pattern string, base boolean>>"
    listed = [
        {"rule": i, "label": label, "priority": p, "weight": w, "keywords": k, "pattern": f"(?<= ){x}(?= )", "base": b}
        for i, (label, p, w, k, x, b) in enumerate(rules())
    ]
    literal = F.from_json(F.lit(json.dumps(listed)), kind)
    spaced = F.concat(F.lit(" "), as_words(F.col("text")), F.lit(" "))
    # written, so that the words of a text are made once and not for every rule; `outer` keeps
    # Spark from testing the rules beforehand to find texts without any
    wide = stage(
        texts.where(let(spaced, gate)).select("doc_id", F.xxhash64("text").alias("text_hash"), spaced.alias("words"))
    )
    has = lambda k: F.contains(F.col("words"), k)
    fitting = F.filter(literal, lambda r: F.forall(r["keywords"], lambda any_of: F.exists(any_of, has)))
    tried = wide.select("*", F.explode_outer(fitting).alias("r")).where(F.col("r").isNotNull())
    # \G holds each match to the end of the one before, so a text without one is read once
    lazy = lambda group: F.concat(F.lit(group), F.col("r.pattern"), F.lit(")"))

    def spaces(x: Column) -> Column:
        return F.char_length(x) - F.char_length(F.replace(x, F.lit(" "), F.lit("")))

    found = tried.select(
        "doc_id", "text_hash", "r.rule", "r.label", "r.priority", "r.weight", "r.base",
        F.transform(F.regexp_extract_all("words", lazy(r"(?s)\G(.*?)(?:"), F.lit(1)), spaces).alias("gaps"),
        F.transform(F.regexp_extract_all("words", lazy(r"(?s)\G.*?("), F.lit(1)), spaces).alias("hits"),
    ).where(F.size("hits") > 0)
    rows = found.select(
        "doc_id", "text_hash", "rule", "label", "priority", "weight", "base",
        F.posexplode(F.arrays_zip("gaps", "hits")).alias("k", "at"),
    ).distinct()  # repeated rows make the same matches
    upto = Window.partitionBy("doc_id", "text_hash", "rule").orderBy("k")
    first = F.sum(F.col("at.gaps") + F.col("at.hits")).over(upto) - F.col("at.hits") - 1
    return stage(
        rows.select(
            "doc_id", "text_hash", "label", "priority", "weight", "base",
            first.alias("first"), (first + F.col("at.hits") + 1).alias("last"),
        )
    )


def surviving(found: DataFrame) -> DataFrame:
    """The spans not inside an earlier one of the same or a stronger priority."""
    order = ["first", F.col("last").desc(), "priority", "label"]
    before = Window.partitionBy("doc_id", "text_hash").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({p for _, p, *_ in rules()})
    reach = [F.max(F.when(F.col("priority") <= p, F.col("last"))).over(before) for p in levels]
    covering = F.lit(None).cast("long")
    for p, r in zip(levels, reach):
        covering = F.when(F.col("priority") == p, r).otherwise(covering)
    return found.withColumn("_reach", covering).where(F.col("_reach").isNull() | (F.col("_reach") < F.col("last"))).drop("_reach")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: n_words, n_base, first_word, last_word, base_labels, labels, score."""
    texts = text_of(docs, id_col, text_col)
    words = as_words(F.col("text"))
    sizes = texts.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        let(words, lambda w: F.when(w == "", 0).otherwise(F.size(F.split(w, " ")))).cast("long").alias("n_words"),
    )
    found = spans(texts)
    base = F.col("base")
    marked = surviving(found).where(~base).withColumn("_kept", F.lit(True))
    both = found.where(base).withColumn("_kept", F.lit(True)).unionByName(marked)
    per_doc = both.groupBy("doc_id", "text_hash").agg(
        F.count_if(base).cast("long").alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"),
        F.max("weight").alias("score"),
    )
    per_doc = per_doc.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    joined = sizes.join(per_doc, same(sizes, per_doc, [("doc_id", "_id"), ("text_hash", "_hash")]), "left")
    return joined.select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
