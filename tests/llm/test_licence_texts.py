"""Licence texts as they are usually wrapped."""

import textwrap

import pytest

from fareloom.llm import licenses

HEAD = "Copyright (c) 2020 A. Writer\n\n"
GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
    'and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions:"
)
NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or "
    "substantial portions of the Software."
)
AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING '
    "BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT."
)
BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met:"
)
ITEMS = (
    "Redistributions of source code must retain the above copyright notice, this list of "
    "conditions and the following disclaimer.",
    "Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution.",
    "Neither the name of the copyright holder nor the names of its contributors may be used to "
    "endorse or promote products derived from this software without specific prior written "
    "permission.",
)
ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies."
)
GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of "
    "the GNU General Public License as published by the Free Software Foundation, either version 3 "
    "of the License, or (at your option) any later version."
)


def wrap(*parts, between="\n\n"):
    return between.join(textwrap.fill(p, 80) for p in parts)


def listed(form, between="\n\n"):
    return wrap(BSD, *(form.format(i + 1) + x for i, x in enumerate(ITEMS)), between=between)


@pytest.mark.parametrize(
    ("text", "licence"),
    [
        (HEAD + wrap(GRANT, NOTICE, AS_IS), "MIT"),
        (HEAD + listed("{}. "), "BSD-3-Clause"),
        (HEAD + listed("{}. ", "\n"), "BSD-3-Clause"),
        (HEAD + listed("({}) ", "\n"), "BSD-3-Clause"),
        (HEAD + listed("* ", "\n"), "BSD-3-Clause"),
        (HEAD + wrap(ISC), "ISC"),
        (HEAD + wrap(GPL), "GPL-3.0-or-later"),
        ((HEAD + wrap(GPL)).replace("\n", "\r\n"), "GPL-3.0-or-later"),
        ("/*\n" + textwrap.indent(HEAD + wrap(GPL), " * ", lambda _: True), "GPL-3.0-or-later"),
    ],
)
def test_wrapped_licence_texts(spark, text, licence):
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    found = {r["license"]: r["n_matches"] for r in licenses.scan(frame).collect()}
    assert found == {licence: 1}
