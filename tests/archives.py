"""Writing feed archives for tests."""

import zipfile


def write_zip(path, *entries):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for i, text in enumerate(entries):
            archive.writestr(f"entry{i}", text)
