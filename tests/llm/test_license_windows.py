"""Licences in headers, longer lines and whole licence files."""

import pytest

from millrace.llm import licenses

MIT_FILE = """The MIT License (MIT)

Copyright (c) 2020 X

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software."""
MIT_0 = MIT_FILE + """, and to permit persons to whom the Software is
furnished to do so.

THE SOFTWARE IS PROVIDED "AS IS"."""
BSD_FILE = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice.

2. Redistributions in binary form must reproduce the above copyright notice in
   the documentation and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS"""
CLAUSE_3 = """
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products.
"""
GNU = "it under the terms of the GNU %sGeneral Public License as published by\nthe Free Software Foundation, either version %s of the License, or"
CASES = [
    (BSD_FILE % "", "BSD-2-Clause"), (BSD_FILE % CLAUSE_3, "BSD-3-Clause"), (BSD_FILE.replace("\n", "\n * ") % "\n *", "BSD-2-Clause"), (MIT_0, "MIT-0"),
    ("MIT No Attribution\n\nCopyright 2020 X", "MIT-0"), ("BSD 2-Clause License", "BSD-2-Clause"),
    ("SPDX-License-Identifier: MIT-0", "MIT-0"), ("// SPDX-License-Identifier: Apache-2.0 OR MIT */", "Apache-2.0 OR MIT"),
    ("SPDX-License-Identifier: (MIT AND GPL-2.0-only WITH Classpath-exception-2.0).", "(MIT AND GPL-2.0-only WITH Classpath-exception-2.0)"),
    ("# SPDX-License-Identifier: MIT\n# SPDX-License-Identifier: ISC\n# SPDX-License-Identifier: MIT", "ISC AND MIT"),
    ("SPDX-License-Identifier: NOASSERTION", None), ("SPDX-License-Identifier: ISC\nReleased under the MIT License.", "ISC"),
    ("This file is not covered by the MIT License.", None), ("Not released under the MIT License.", None),
    ("This file is not covered by the GPL. Released under the MIT License.", "MIT"),
    ("you may not use this file except in compliance\nLicensed under the Apache License, Version 2.0.", "Apache-2.0"),
    (MIT_FILE.split("\n\n", 2)[2].replace("granted, free", "given, free"), "MIT"), (MIT_FILE.split("\n\n", 2)[2].replace("associated", "accompanying"), "MIT"),
    (GNU % ("Lesser ", 3), "LGPL-3.0"), (GNU % ("Affero ", 3), "AGPL-3.0"), (GNU % ("", 2), None), ((GNU % ("", 3)).replace("as published", "published"), "GPL-3.0"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", None),
    ("This work is licensed under the GNU General Public License, version 2.", None),
    ("This work is licensed under the GNU Lesser General Public License, version 3.", None),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0"), ("Licensed under CC BY-NC-SA 4.0.", None), ("word " * 60_000 + "MIT License " + "word " * 60_000, "MIT"),
    ("MIT License", "MIT"), ("The MIT License (MIT)", "MIT"), ("# SPDX-License-Identifier: MIT\nimport os", "MIT"), (MIT_FILE, "MIT"),
    (MIT_FILE.split("\n\n", 2)[2], "MIT"), ("Copyright (c) 2020 X. All rights reserved.", "proprietary"),
    ("This project is released under the MIT License, see the file LICENSE for details.", "MIT"),
    ("Copyright (c) 2020, X\nAll rights reserved.\n\nRedistribution and use in source and binary forms, with or without\n"
     "modification, are permitted provided that the following conditions are met:\n* one", "BSD-3-Clause"),
    ("// Redistribution and use in source and binary forms, with or without\n// modification, are permitted provided that the following\n"
     "// conditions are met:", "BSD-3-Clause"),
    ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\n"
     "the Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.", "GPL-3.0"),
    ("GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nCopyright (C) 2007", "GPL-3.0"),
    ("Apache License\n  Version 2.0, January 2004\n  http://www.apache.org/licenses/", "Apache-2.0"),
    ("/* Licensed under the Apache License, Version 2.0 (the \"License\");\n you may not use this file */", "Apache-2.0"),
    ("Mozilla Public License Version 2.0\n====\n1. Definitions", "MPL-2.0"),
    ("Creative Commons Attribution-NonCommercial 4.0 International Public License", "CC-BY-NC-4.0"),
    ("GNU LESSER GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007", None), ("GNU General Public License\nversion 2", None),
    ("Creative Commons Attribution-ShareAlike 4.0 International", None), ("the rights of all are reserved by license", None),
]


@pytest.fixture(scope="module")
def found(spark):
    files = spark.createDataFrame([(f"{k}/f", text, False) for k, (text, _) in enumerate(CASES)], "path string, text string, licence_file boolean")
    return {r.path: r.own_license for r in licenses.scan_licenses(files).collect()}


@pytest.mark.parametrize("case", range(len(CASES)))
def test_stated_licence(found, case):
    assert found[f"{case}/f"] == CASES[case][1], CASES[case][0]
