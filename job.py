"""Starts the streaming job under ``spark-submit``; see ``tallywatch/__main__.py``."""

from tallywatch.__main__ import main

if __name__ == "__main__":
    main()
