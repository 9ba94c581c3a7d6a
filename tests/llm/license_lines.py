"""Lines that speak of licenses and lines that don't, with the families that a scan must report (None: unknown)."""

from __future__ import annotations

MIT_TEXT = """MIT License

Copyright (c) 2020 Foo Bar

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
ISC_TEXT = """ISC License

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""
APACHE_TEXT = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at the usual place.
"""


def gnu(name: str, version: str) -> str:
    return (
        f"This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU {name} as published by\n"
        f"the Free Software Foundation, either version {version} of the License, or\n(at your option) any later version."
    )


LINES: list[tuple[str, list[str | None]]] = [
    # versions
    ("licensed under the GNU General Public License, version 2", ["GPL-2.0"]),
    ("Licensed under the GNU General Public License, version 3.", ["GPL-3.0"]),
    ("This project is licensed under the GPLv2.", ["GPL-2.0"]),
    ("This project is licensed under GPLv3 or later.", ["GPL-3.0"]),
    ("Released under the GPL v3.", ["GPL-3.0"]),
    ("Released under the GPL version 2 only.", ["GPL-2.0"]),
    ("You may use it under the GNU General Public License.", ["GPL"]),
    ("Distributed under the GNU GPL, version 3 or any later version.", ["GPL-3.0"]),
    ("Licensed under the GNU Lesser General Public License, version 2.1.", ["LGPL-2.1"]),
    ("Licensed under the GNU Lesser General Public License v3.0.", ["LGPL-3.0"]),
    ("The library is available under LGPL 2.1.", ["LGPL-2.1"]),
    ("Licensed under the GNU Lesser General Public License.", ["LGPL"]),
    ("Licensed under the GNU Affero General Public License, version 3.", ["AGPL-3.0"]),
    ("The server is published under AGPLv3.", ["AGPL-3.0"]),
    ("Licensed under the Apache License, Version 2.0.", ["Apache-2.0"]),
    ("Apache License, Version 1.1", ["Apache-1.1"]),
    ("Licensed under the Apache License, Version 1.1.", ["Apache-1.1"]),
    ("The sources are under the Apache 2.0 license.", ["Apache-2.0"]),
    ("Released under the Apache License v2.0.", ["Apache-2.0"]),
    ("Apache License 2.0", ["Apache-2.0"]),
    ("Released under the Apache License.", ["Apache"]),
    ("This file is under the Mozilla Public License, version 1.1.", ["MPL-1.1"]),
    ("This file is under the Mozilla Public License, version 2.0.", ["MPL-2.0"]),
    ("Available under MPL 2.0.", ["MPL-2.0"]),
    ("This program is made available under the terms of the Eclipse Public License v2.0.", ["EPL-2.0"]),
    ("Made available under the Eclipse Public License, version 1.0", ["EPL-1.0"]),
    # clauses
    ("Distributed under the BSD 2-Clause License.", ["BSD-2-Clause"]),
    ("Distributed under the BSD 3-Clause License.", ["BSD-3-Clause"]),
    ("Released under the 3-clause BSD license.", ["BSD-3-Clause"]),
    ("Released under the simplified BSD license.", ["BSD-2-Clause"]),
    ("Released under the new BSD license.", ["BSD-3-Clause"]),
    ("Released under the BSD license.", ["BSD"]),
    # parts of Creative Commons names
    ("Licensed under CC BY 4.0.", ["CC-BY"]),
    ("Licensed under CC BY-ND 4.0.", ["CC-BY-ND"]),
    ("Licensed under CC BY-SA 4.0.", ["CC-BY-SA"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC"]),
    ("Licensed under CC BY-NC-SA 3.0.", ["CC-BY-NC-SA"]),
    ("Licensed under CC BY-NC-ND 4.0.", ["CC-BY-NC-ND"]),
    ("Text is available under CC-BY-SA 3.0.", ["CC-BY-SA"]),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY"]),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", ["CC-BY-SA"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", ["CC-BY-NC"]),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", ["CC-BY-ND"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.", ["CC-BY-NC-SA"]),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 2.5 Generic License.", ["CC-BY-NC-ND"]),
    ("The data are dedicated to the public domain under CC0.", ["CC0"]),
    ("Published under CC0 1.0.", ["CC0"]),
    # tags
    ("SPDX-License-Identifier: MIT", ["MIT"]),
    ("# SPDX-License-Identifier: Apache-2.0", ["Apache-2.0"]),
    ("// SPDX-License-Identifier: GPL-2.0-only", ["GPL-2.0"]),
    ("// SPDX-License-Identifier: GPL-3.0-or-later", ["GPL-3.0"]),
    ("SPDX-License-Identifier: LGPL-2.1-or-later", ["LGPL-2.1"]),
    ("SPDX-License-Identifier: AGPL-3.0-only", ["AGPL-3.0"]),
    ("SPDX-License-Identifier: BSD-2-Clause", ["BSD-2-Clause"]),
    ("SPDX-License-Identifier: BSD-3-Clause", ["BSD-3-Clause"]),
    ("SPDX-License-Identifier: MPL-2.0", ["MPL-2.0"]),
    ("SPDX-License-Identifier: ISC", ["ISC"]),
    ("SPDX-License-Identifier: CC-BY-NC-4.0", ["CC-BY-NC"]),
    ("SPDX-License-Identifier: CC0-1.0", ["CC0"]),
    ("SPDX-License-Identifier: BSL-1.0", ["BSL-1.0"]),
    ("SPDX-License-Identifier: EPL-2.0", ["EPL-2.0"]),
    ("SPDX-License-Identifier: Zlib", [None]),
    ("SPDX-License-Identifier: OFL-1.1", [None]),
    # names alone, and among other words
    ("Copyright 2020 Foo. MIT License.", ["MIT"]),
    ("Released under the MIT License.", ["MIT"]),
    ("License: MIT", ["MIT"]),
    ("This package is under the ISC license.", ["ISC"]),
    ("Covered by the Boost Software License.", ["BSL-1.0"]),
    ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
    ("Released into the public domain under the Unlicense.", ["Unlicense"]),
    ("Copyright 2019 Foo Inc. All rights reserved.", ["all-rights-reserved"]),
    ("Code: licensed under the Apache License, Version 2.0. Text: licensed under CC BY 4.0.", ["Apache-2.0", "CC-BY"]),
    ("Dual licensed under the MIT License and the Apache License, Version 2.0.", ["MIT", "Apache-2.0"]),
    ("Released under the MIT licence.", ["MIT"]),
    # whole texts and headers
    (MIT_TEXT, ["MIT"]),
    (ISC_TEXT, ["ISC"]),
    (APACHE_TEXT, ["Apache-2.0"]),
    (gnu("General Public License", "2"), ["GPL-2.0"]),
    (gnu("General Public License", "3"), ["GPL-3.0"]),
    (gnu("Lesser General Public License", "3"), ["LGPL-3.0"]),
    (gnu("Affero General Public License", "3"), ["AGPL-3.0"]),
    ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
    # licenses of no known family or version
    ("Licensed under the Frobnicate License.", [None]),
    ("Released under the Quux License, version 2.", [None]),
    ("Licensed under the Apache License, Version 3.7.", [None]),
    ("Licensed under the GNU General Public License, version 9.", [None]),
    ("Distributed under the Wobble Public License.", [None]),
    ("This work is licensed under the Gribble terms.", [None]),
    ("Covered by the Sprocket Software License.", [None]),
    ("License: Snarfblat", [None]),
    # everyday uses
    ("The pub kept its liquor license under the new terms of the council.", []),
    ("Her driving license was issued in 1998 by the county.", []),
    ("A hunting license costs forty dollars in that state.", []),
    ("He wrote down the license plate number of the van.", []),
    ("The poet took some license with the dates.", []),
    ("Only licensed plumbers may work on gas pipes.", []),
    ("The station lost its broadcasting license after the hearing.", []),
    ("He studied at MIT and later taught physics.", []),
    ("The Apache helicopter landed at noon.", []),
    ("The general public was invited to the opening.", []),
    ("The foundation published a free guide to redistribution of food.", []),
    ("Permission is required to enter the building.", []),
    ("All rights of way are marked on the map.", []),
    ("A creative approach to the commons was proposed.", []),
    ("They sold the software without any warranty.", []),
    ("The rights to the film were reserved for the studio.", []),
    ("The marriage license was signed by the clerk.", []),
    ("Version 2 of the plan was released to the public.", []),
    ("The new law licenses drones over cities.", []),
    ("Attribution of the painting is disputed.", []),
]

#: written after the templates and wordings were settled; nothing was changed for them
FRESH: list[tuple[str, list[str | None]]] = [
    ("This repository uses the MIT License, see the file for details.", ["MIT"]),
    ("You can redistribute the maps under CC BY-SA 2.0.", ["CC-BY-SA"]),
    ("Images by the museum, CC BY-NC-ND 3.0.", ["CC-BY-NC-ND"]),
    ("Our firmware ships with components under the GNU LGPL version 2.1.", ["LGPL-2.1"]),
    ("The parser is free software under the terms of GPLv3.", ["GPL-3.0"]),
    ("Contributions are accepted under the Apache License, Version 2.0 only.", ["Apache-2.0"]),
    ("The examples in this book are BSD 3-Clause licensed.", ["BSD-3-Clause"]),
    ("The plugin is offered under the Eclipse Public License 2.0.", ["EPL-2.0"]),
    ("Portions of this page are under the Mozilla Public License 2.0.", ["MPL-2.0"]),
    ("This dataset is released under Creative Commons Zero.", ["CC0"]),
    ("Copyright by the press. All rights reserved worldwide.", ["all-rights-reserved"]),
    ("The network daemon is covered by the GNU Affero General Public License v3.", ["AGPL-3.0"]),
    ("Source code under the ISC License.", ["ISC"]),
    ("/* SPDX-License-Identifier: MPL-1.1 */", ["MPL-1.1"]),
    ("Licensed under the Blorptastic Software License, version 4.", [None]),
    ("This archive is distributed under the Zibber Public License.", [None]),
    ("SPDX-License-Identifier: Artistic-2.0", [None]),
    ("The captain held a pilot license for small boats.", []),
    ("Vendors without a license had to leave the square.", []),
    ("The library is open to the general public on Sundays.", []),
    ("She was licensed to practise law in two states.", []),
    ("The treaty reserved all rights to the fishing grounds.", []),
    ("Version 3 of the report was published by the foundation.", []),
    ("The county clerk issues a business license every spring.", []),
    ("The mission of MIT is to advance knowledge.", []),
    ("An apache dance was shown in the public theatre.", []),
]
