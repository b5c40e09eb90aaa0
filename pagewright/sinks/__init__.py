"""Writers: Markdown, JSON, model envelopes, HTML reports, dead letters, markers."""
