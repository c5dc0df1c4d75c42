"""Notices of licence families, and sentences that only look like them."""

# The wording of public licence notices.
NOTICES = {
    "MIT": [
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the Software without restriction",
        'Released under the MIT Licence.',
        'The MIT License (MIT)',
        '@license MIT',
        'The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.',
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        'Apache License Version 2.0, January 2004',
        'Released under the Apache 2.0 License.',
        '@license Apache-2.0',
        'You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0',
        'WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
        "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU GPL version 2.",
        'GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007',
        '@license GPL-3.0-or-later',
        'You should have received a copy of the GNU General Public License along with this program.',
        'This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.',
    ],
    "LGPL": [
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
        'GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007',
        '@license LGPL-3.0-or-later',
        'You should have received a copy of the GNU Lesser General Public License along with this library.',
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License, version 3.",
        "SPDX-License-Identifier: AGPL-3.0-only",
        "You should have received a copy of the GNU Affero General Public License along with this program.",
        'GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007',
        '@license AGPL-3.0-only',
        'it under the terms of the GNU Affero General Public License as published by the Free Software Foundation',
    ],
    "MPL": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
        "Licensed under the Mozilla Public License 2.0.",
        'Mozilla Public License Version 2.0',
        '@license MPL-2.0',
        'If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.',
    ],
    "BSD": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-2-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the simplified BSD license.",
        'Released under the BSD 2-Clause License.',
        '@license BSD-3-Clause',
        'The 3-Clause BSD License',
        'Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.',
        'Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.',
        'Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.',
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.',
    ],
    "ISC": [
        "Released under the ISC License.",
        "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        '@license ISC',
        'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS.',
    ],
    "EPL": [
        'Eclipse Public License - v 2.0',
        'Eclipse Public License - v 1.0',
        'SPDX-License-Identifier: EPL-2.0',
        '@license EPL-2.0',
        'This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0',
        'THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE',
    ],
    "Zlib": [
        'Released under the zlib License.',
        'SPDX-License-Identifier: Zlib',
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.",
        'Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:',
        'The origin of this software must not be misrepresented; you must not claim that you wrote the original software.',
        'Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.',
    ],
    "BSL-1.0": [
        'Distributed under the Boost Software License, Version 1.0.',
        'SPDX-License-Identifier: BSL-1.0',
        'Boost Software License - Version 1.0 - August 17th, 2003',
        'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license',
    ],
    "Artistic-2.0": [
        'Licensed under the Artistic License 2.0.',
        'SPDX-License-Identifier: Artistic-2.0',
        'You may redistribute it under the terms of the Artistic License 2.0.',
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "CC0": [
        "Dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
        "SPDX-License-Identifier: Unlicense",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    ],
}

# Sentences with words of licences that grant nothing.
LOOKALIKES = [
    "All rights reserved.",
    "A driving license is required to rent a car.",
    "The license plate of the vehicle could not be read.",
    "Her license to practise medicine was renewed in version 2 of the register.",
    "Students at MIT released a new robot.",
    "The Apache helicopter landed near the river.",
    "General public opinion of the commission changed.",
    "Read the terms of service and the privacy policy before you register.",
    "The software was distributed on four disks.",
    "You need permission to use the swimming pool.",
    "The creative director praised the common room and its attribution of roles.",
    "The court granted the restaurant a licence to sell alcohol.",
    "Copyright law is taught in the third year.",
    "The public library is open to any person free of charge.",
    "Mozilla published version 2 of its browser.",
    "Source and binary stars are shown with or without colour.",
    "The domain of the function is free of singularities.",
    "BSD and ISC are acronyms with several meanings.",
    "Version 3 of the file is a copy of the first.",
    "This program is on air every Sunday, free for all.",
    "The foundation publishes a general report under the terms of the act.",
    "Software license fees rose by 4.0 percent.",
    "Commercial use of the lake is not permitted.",
    "The notice was published under the apache pine.",
    'The eclipse was public and could be seen without a licence.',
    'An artistic programme was distributed under the terms of the festival.',
    'The warranty covers damages to the engine for two years.',
    'In no event was the driver held liable for the damages.',
    'The author disclaims any connection with the company.',
    'She gave a boost to the software version.',
    'The above conditions apply to the list of materials.',
    'Neither the name of the street nor the number of the house was known.',
    'Permission was granted to anyone who asked.',
    'Mozilla and Eclipse are names of programs.',
]

# Words that say nothing about a licence by themselves.
PLAIN_WORDS = (
    "a all an and any applicable are as at be by can either for form from have hereby in is it its may not of on or person possible "
    "provided received related should that the this to under unless use used with without work you your along extent deal following "
    "agreed required writing met project file program purpose"
).split()
