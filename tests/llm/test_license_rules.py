import re
import textwrap

from transitlab.llm import license_rules as lr


def norm(s):
    s = re.sub(r"(?<![0-9])\.|\.(?![0-9])|[^\w.]+|_", " ", s.lower())
    return re.sub(" +", " ", s).strip()


def brute(text, known=lr.SENTENCES, rules=lr.RULES):
    lookup = {norm(s): i for i, s in known}
    ids = [lookup[n] for s in re.split(r"[\n\r]+|(?<=[.!?;:])[ \t]+", text or "") if (n := norm(s)) in lookup]
    out, at = [], 0
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    while at < len(ids):
        for name, seq in ordered:
            if tuple(ids[at:at + len(seq)]) == tuple(seq):
                out.append(name)
                at += len(seq)
                break
        else:
            at += 1
    return ids, out


TEXTS = [
    "Some text.\nLicensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License. More."
    " You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0\nend",
    "LICENSED UNDER THE  MIT   LICENSE!\nRandom words here. The software is provided \"as is\", without warranty of any kind, express or implied.",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    " (the \"Software\"), to deal in the Software without restriction. Unknown clause. The software is provided \"as is\", without warranty of any"
    " kind, express or implied",
    "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.\nLicensed under CC BY 4.0.", "Licensed under CC BY 4.1.", "", None,
    "Apache License Version 2.0", "All rights reserved.", "x " * 50_000 + "\nReleased under the MIT License.",
]


def test_equals_brute_force(spark):
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(TEXTS)] + [(0, TEXTS[0], "mine")], "doc_id long, text string, licenses string")
    got = lr.scan(df).collect()
    assert len(got) == len(TEXTS) + 1
    for r in got:
        assert (r["sentence_ids"], r["licenses"]) == brute(TEXTS[r["doc_id"]])
    assert [r["licenses"] for r in got if r["doc_id"] == 0] == [["Apache-2.0"]] * 2
    assert lr.scan(df.limit(0)).count() == 0


def test_own_tables_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "One a. Two b. One a.")], "doc_id long, text string")
    row = lr.scan(df, [("x", "one a"), ("y", "two b")], [("L", ("x", "y")), ("M", ("x",)), ("never", ("z",))]).first()
    assert (row["sentence_ids"], row["licenses"]) == (["x", "y", "x"], ["L", "M"])
    assert lr.scan(df, [], lr.RULES).first()["licenses"] == [] and lr.scan(df, lr.SENTENCES, []).first()["licenses"] == []


def test_plan_is_one_pass(spark):
    df = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = lr.scan(df)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan


NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation \
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, \
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, \
subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF \
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE.""",
    "Apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with \
the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, \
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language.""",
    "GPL-3.0-or-later": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General \
Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the \
following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the \
documentation and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this \
software without specific prior written permission.""",
}


def test_published_notices_wrapped_and_on_one_line(spark):
    rows = []
    for name, notice in NOTICES.items():
        paragraphs = notice.split("\n\n")
        rows.append((name, "Copyright (c) 2020 A. Person\n\n" + notice))
        rows.append((name, " ".join(notice.split())))
        for width, sign in ((72, ""), (60, " * "), (50, "# "), (40, "// "), (64, "REM ")):
            lines = [line for p in paragraphs for line in textwrap.wrap(p.strip(), width) + [""]]
            rows += [(name, end.join(sign + line for line in lines)) for end in ("\n", "\r\n")]
    rows.append(("", "Permission is hereby granted, free of charge.\nThis program is free software: you can redistribute it."))
    got = lr.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows)
    assert [(r["doc_id"], r["licenses"]) for r in got] == [(n, [n] if n else []) for n, _ in rows]


def test_a_column_of_the_name_used_inside(spark):
    docs = spark.createDataFrame([(1, "Permission is hereby granted", "x", "y")], "doc_id long, text string, _ids string, __ids string")
    row = lr.scan(docs).first()
    assert (row["_ids"], row["__ids"]) == ("x", "y")
