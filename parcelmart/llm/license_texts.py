"""License templates: fixed values, short notices and opening paragraphs of public licenses."""

TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-notice": (
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "mit": "Released under the MIT License.",
    "mit-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to "
        "permit persons to whom the Software is furnished to do so"
    ),
    "bsd-text": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "isc-text": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    ),
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation"
    ),
    "lgpl-notice": (
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"
    ),
    "agpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation"
    ),
    "gpl-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "lgpl-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "lgpl-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0.",
    "cc-by-nc-4.0-notice": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    "cc-by-nd-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License",
    "cc-by-nc-sa-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License",
    "cc-by-nc-nd-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License",
    "cc0-1.0": "To the extent possible under law, the author has waived all copyright and related rights to this work",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}
