"""Column functions: text helpers, frontmatter, Markdown, URLs."""
